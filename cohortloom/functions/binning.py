"""Right-closed intervals (lo, hi] over integer days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortloom.sources.schemas import HORIZON

Bin = tuple[int, int]


def bin_label(lo: int, hi: int) -> str:
    return f"({lo}, {hi}]"


def pair_up(edges: list[int]) -> list[Bin]:
    return list(zip(edges[:-1], edges[1:]))


def cohort_bins(split_day: int = 23, step: int = 7) -> list[Bin]:
    """Registration cohorts: edges counted back from the split day, with 0 in front."""
    edges = sorted({0, *range(split_day, 0, -step)})
    return pair_up(edges)


def period_bins(edge: int, step: int = 7, horizon: int = HORIZON) -> list[Bin]:
    """Periods after ``edge``; the last one ends at the horizon and may be shorter."""
    edges = [*range(edge, horizon, step), horizon]
    return pair_up(edges)


def in_bin(column: Column, lo: Column | int, hi: Column | int) -> Column:
    return (column > lo) & (column <= hi)


def bin_index(column: Column, bins: list[Bin]) -> Column:
    """Position of the bin a day falls into; NULL outside all bins.

    The edges are literals, so this stays one CASE inside the projection.
    """
    choice = F.lit(None).cast("int")
    for position, (lo, hi) in reversed(list(enumerate(bins))):
        choice = F.when(in_bin(column, lo, hi), F.lit(position)).otherwise(choice)
    return choice


def bin_table(spark: SparkSession, bins: list[Bin], name: str) -> DataFrame:
    """The bins as rows; its size is the length of a parameter list."""
    rows = [(i, lo, hi, bin_label(lo, hi)) for i, (lo, hi) in enumerate(bins)]
    return spark.createDataFrame(rows, f"{name}_no int, lo long, hi long, {name} string")
