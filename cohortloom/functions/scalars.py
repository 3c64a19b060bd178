"""Fill, recode, difference, ratio and cast expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from cohortloom.sources.schemas import MISSING


def fill_missing(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Missing text becomes '-1', missing numbers -1; no column changes its type."""
    wanted = set(columns) if columns is not None else set(df.columns)
    text = [f.name for f in df.schema if f.name in wanted and isinstance(f.dataType, StringType)]
    numbers = [f.name for f in df.schema if f.name in wanted and isinstance(f.dataType, NumericType)]
    if text:
        df = df.na.fill(MISSING, text)
    if numbers:
        df = df.na.fill(-1, numbers)
    return df


def recode(column: Column, old, new) -> Column:
    """``old`` becomes ``new``, everything else stays."""
    return F.when(column == F.lit(old), F.lit(new)).otherwise(column)


def ratio(above: Column, below: Column) -> Column:
    """True division; a zero or missing divisor gives NULL, also in ANSI mode."""
    return F.try_divide(above.cast("double"), below.cast("double"))


def place_columns(df: DataFrame, column: str, position: int) -> DataFrame:
    """Move one column to a position, in a single projection."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest[:position], column, *rest[position:])


def rename_all(df: DataFrame, rule, keep: Iterable[str] = ()) -> DataFrame:
    """Rename every column by a rule, keys excepted."""
    kept = set(keep)
    return df.toDF(*[c if c in kept else rule(c) for c in df.columns])


def to_long(column: Column) -> Column:
    """Text to BIGINT; what is no number becomes NULL instead of failing the job."""
    return column.try_cast("long")
