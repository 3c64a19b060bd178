"""User-activity features, cohorts, click rates and feature screening as Spark jobs."""

__version__ = "0.1.0"
