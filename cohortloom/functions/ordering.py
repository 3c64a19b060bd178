"""Running totals and ranks over an order that is too long for one task.

A window without a bounded partition would send all rows to a single task. Here
the rows are range-partitioned by the order, each range is summed on its own, the
sums of the earlier ranges are put in front of each range as one carry row, and a
window per range does the rest. No task sees more than one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortloom.session import settle


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    measures: Sequence[str],
    descending: Sequence[str] = (),
) -> DataFrame:
    """Add ``<m>_upto`` (this row included) and ``<m>_all`` for each measure.

    ``df`` holds one row per (by, order): aggregate first, so that ties and hot
    keys are one row each before anything is sorted.
    """
    ordering: list[Column] = [
        F.col(c).desc_nulls_last() if c in descending else F.col(c).asc_nulls_last() for c in order
    ]
    ranged = df.repartitionByRange(*[F.col(c).asc() for c in by], *ordering)
    placed = settle(ranged.withColumn("_range", F.spark_partition_id()))

    group = [F.col(c) for c in by] or [F.lit(0)]
    ranges = placed.groupBy(*by, "_range").agg(*[F.sum(m).alias(m) for m in measures])
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    carry = ranges.select(
        *by,
        "_range",
        F.lit(0).alias("_row"),
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"{m}_step") for m in measures],
        *[F.sum(m).over(whole).alias(f"{m}_whole") for m in measures],
    )
    rows = placed.select(
        "*", F.lit(1).alias("_row"), *[F.col(m).alias(f"{m}_step") for m in measures]
    ).unionByName(carry, allowMissingColumns=True)

    upto = (
        Window.partitionBy(*by, "_range")
        .orderBy("_row", *ordering)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.select(
            *df.columns,
            "_row",
            *[F.sum(f"{m}_step").over(upto).alias(f"{m}_upto") for m in measures],
            *[F.max(f"{m}_whole").over(upto).alias(f"{m}_all") for m in measures],
        )
        .filter(F.col("_row") == 1)
        .drop("_row")
    )


def positions(
    df: DataFrame, by: Sequence[str], order: Sequence[str], descending: Sequence[str] = ()
) -> DataFrame:
    """Add ``position`` (1 for the first) within each group of ``by``."""
    ranked = running_totals(df.withColumn("_one", F.lit(1)), by, order, ["_one"], descending)
    return ranked.select(*df.columns, F.col("_one_upto").cast("long").alias("position"))
