"""The feature, cohort, encoding, rate and screening jobs."""
