"""Connected components over links, by turns of large and small stars.

A turn links every node to the smallest node it sees. The smallest neighbour is an
aggregate (combined before the shuffle) and the rest is a join on the node, in which
adaptive execution splits a hot node, so a hub with most of the links is no single task.
Each turn is a written table: lineage stays short and a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortloom.llm.common import Written


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of an edge (a, b) with the smallest node it is connected to."""
    keep = Written(edges.sparkSession)
    now = keep(edges.filter("a != b").select("a", "b"))
    state = None
    while True:
        turned = keep(_small(_large(now)))
        keep.drop(now)
        now = turned
        # three numbers tell whether a turn changed anything
        row = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))
    ).distinct()
