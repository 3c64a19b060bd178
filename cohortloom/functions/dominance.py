"""Sums over all points that lie before a query point in two orders at once.

Points have a place in a first and in a second order, both 1..n without gaps, and weights.
A query (first, second) asks for the sum of the weights of all points with a place of at
most ``first`` and at most ``second``. Both orders are cut into the same number of ranges.
What lies in whole ranges of both is a carry of at most MOST_RANGES squared sums; what is
left lies in the query's own range of the first order or, before that, in its own range
of the second: every row is looked at in two groups, each holding one range. Queries may be far
from even over the ranges (of the second order above all: many may ask for nearly one
place), so a range with more queries than it should hold is asked in several groups, each with
all of its points.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.session import settle

# Tasks get these functions themselves: the library need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of a range, and how many ranges there are at most.
RANGE_ROWS = 1 << 16
MOST_RANGES = 256
# Queries of a group for each point of a whole range.
QUERIES = 2


def sums_before(places: np.ndarray, weights: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Sums of the first ``first[q]`` rows of ``weights`` whose place is below ``second[q]``.

    ``places`` is a permutation of 0..n-1. Bit by bit, rows are dealt by the bit of their
    place, keeping their order: a query with that bit set takes the zeros among its rows.
    """
    found = np.zeros((len(first), weights.shape[1]), weights.dtype)
    lo, hi = np.zeros(len(first), np.int64), first.astype(np.int64)
    for bit in range(len(places).bit_length() - 1, -1, -1):
        ones = (places >> bit) & 1
        zeros = np.concatenate([[0], np.cumsum(1 - ones)])
        totals = np.vstack([np.zeros((1, weights.shape[1]), weights.dtype), np.cumsum(weights * (1 - ones)[:, None], axis=0)])
        takes = ((second >> bit) & 1).astype(bool)
        found[takes] += totals[hi[takes]] - totals[lo[takes]]
        lo, hi = np.where(takes, zeros[-1] + lo - zeros[lo], zeros[lo]), np.where(takes, zeros[-1] + hi - zeros[hi], zeros[hi])
        order = np.argsort(ones, kind="stable")
        places, weights = places[order], weights[order]
    return found


def _within(points: pd.DataFrame, first: np.ndarray, second: np.ndarray, measures: list[str]) -> np.ndarray:
    """Sums over the points of one range with at most these places in the two orders."""
    points = points.sort_values("first")
    seconds = np.sort(points["second"].to_numpy())
    places = np.searchsorted(seconds, points["second"].to_numpy())
    k = np.searchsorted(points["first"].to_numpy(), first, "right")
    x = np.searchsorted(seconds, second, "right")
    return sums_before(places, points[measures].to_numpy(), k, x)


def dominated(rows: DataFrame, keys: Sequence[str], measures: Sequence[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """(keys, first, <measures>) of each query: the sums over the points it dominates.

    ``rows`` has point (boolean), first, second, the keys and measures; those of queries
    are ignored. A query's places need not be those of a point.
    """
    spark = rows.sparkSession
    measures = list(measures)
    columns = ["point", "first", "second", *keys, *measures]
    rows = rows.select(
        *columns[:3], *keys, *[F.when(F.col("point"), F.col(m)).otherwise(0).cast("long").alias(m) for m in measures]
    )
    n = rows.filter("point").count()
    width = max(range_rows, -(-n // MOST_RANGES), 1)
    ranges = -(-n // width) + 1
    block = lambda name: F.floor((F.col(name) - 1) / width)
    whole = rows.filter("point").groupBy(block("first").cast("int").alias("a"), block("second").cast("int").alias("b"))
    carry = np.zeros((ranges + 1, ranges + 1, len(measures)), np.int64)
    # ranges squared rows at most
    for r in whole.agg(*[F.sum(m).alias(m) for m in measures]).collect():
        carry[r["a"] + 1, r["b"] + 1] = [r[m] for m in measures]
    sent = spark.sparkContext.broadcast(carry.cumsum(axis=0).cumsum(axis=1))

    def in_first(pdf: pd.DataFrame) -> pd.DataFrame:
        """Queries take what lies in their range of the first order, and the carry."""
        points, queries = pdf[pdf["point"]], pdf[~pdf["point"]].copy()
        first, second = queries["first"].to_numpy(), queries["second"].to_numpy()
        a = np.minimum((first - 1) // width, ranges)
        queries[measures] = _within(points, first, second, measures) + sent.value[a, np.minimum(second // width, ranges)]
        return queries[columns]

    def in_second(pdf: pd.DataFrame) -> pd.DataFrame:
        """Then what lies in their range of the second order, in earlier ranges of the first."""
        points, queries = pdf[pdf["point"]], pdf[~pdf["point"]].copy()
        before = (queries["first"].to_numpy() - 1) // width * width
        queries[measures] += _within(points, before, queries["second"].to_numpy(), measures)
        return queries[columns]

    schema = rows.select(*columns).schema
    most = QUERIES * width
    turned = _dealt(rows, block("first"), most).groupBy("_range", "_group").applyInPandas(in_first, schema)
    own = F.when(F.col("point"), block("second")).otherwise(F.floor(F.col("second") / width))
    asked = settle(turned).unionByName(rows.select(*columns).filter("point"))
    answered = _dealt(asked, own, most).groupBy("_range", "_group").applyInPandas(in_second, schema)
    return answered.drop("point", "second")


def _dealt(rows: DataFrame, place: Column, most: int) -> DataFrame:
    """Rows with their range and group: no group has many more than ``most`` queries.

    Queries of a range are dealt over its groups by their values, and its points stand in each of them.
    """
    placed = rows.withColumn("_range", place)
    asked = placed.filter(~F.col("point")).groupBy("_range").agg(F.count(F.lit(1)).alias("_asked"))
    # a row per range: MOST_RANGES and one at most
    groups = asked.select("_range", F.ceil(F.col("_asked") / most).cast("int").alias("_groups"))
    met = placed.join(F.broadcast(groups), "_range")
    own = F.array(F.pmod(F.xxhash64(*rows.columns), F.col("_groups")).cast("int"))
    every = F.sequence(F.lit(0), F.col("_groups") - 1)
    return met.withColumn("_group", F.explode(F.when(F.col("point"), every).otherwise(own))).drop("_groups")
