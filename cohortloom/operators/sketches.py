"""Distinct counts by mergeable sketches, one per key and day.

A day's sketch is built once and stored; the distinct count of any window of days is the
estimate of the union of its days' sketches. A sketch has a fixed size whatever it
has seen, so neither a hot key nor a long window is a large group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from cohortloom.operators.windows import DayWindow

# Logarithm of the number of registers of a sketch.
LG_K = 12


def error_bound(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """Relative error that a united estimate stays within, at so many standard deviations."""
    return deviations * 1.04 / 2 ** (lg_k / 2)


def daily_sketches(log: DataFrame, keys: Sequence[str], columns: Mapping[str, str], lg_k: int = LG_K) -> DataFrame:
    """(keys, day, <name> ..): a sketch of the distinct values of each column, combined map-side."""
    return log.groupBy(*keys, "day").agg(
        *[F.hll_sketch_agg(F.col(column), F.lit(lg_k)).alias(name) for name, column in columns.items()]
    )


def window_estimates(
    sketches: DataFrame, keys: Sequence[str], names: Sequence[str], windows: Sequence[DayWindow]
) -> DataFrame:
    """(window, keys, <name> ..): estimates over the days of each window, from stored sketches only."""
    days = [
        (w.name, day) for w in windows for day in range(w.start if w.start is not None else 1, w.last_log_day + 1)
    ]
    # windows times days
    table = sketches.sparkSession.createDataFrame(days, "window string, day long")
    return sketches.join(F.broadcast(table), "day").groupBy("window", *keys).agg(
        *[F.hll_sketch_estimate(F.hll_union_agg(F.col(name))).alias(name) for name in names]
    )
