"""Splits that depend on the key alone, so they survive any change of partitioning."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

_SLOTS = 10_000


def hash_slot(keys: Sequence[str], seed: int = 0) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(_SLOTS))


def text_slot(keys: Sequence[str], seed: int = 0) -> Column:
    """A slot from the keys' text by MD5, which other engines can compute too."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(_SLOTS))


def split_column(keys: Sequence[str], valid: float, seed: int = 0) -> Column:
    """1 for training rows, 0 for the validation share."""
    share = round(valid * _SLOTS)
    return F.when(hash_slot(keys, seed) < share, 0).otherwise(1)


def train_valid_split(
    df: DataFrame, keys: Sequence[str], valid: float = 0.3, seed: int = 0, slot: Callable[..., Column] = hash_slot
) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows; the parts are disjoint and depend on the keys alone."""
    marked = slot(keys, seed) < round(valid * _SLOTS)
    return df.filter(~marked), df.filter(marked)


def fold(keys: Sequence[str], folds: int, seed: int = 0) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(folds)).cast("int")


def stack_sets(train: DataFrame, test: DataFrame, mark: str = "label", value: int = -1) -> DataFrame:
    """Labelled and test rows in one frame; test rows carry ``value`` as their label."""
    return train.unionByName(
        test.drop(mark).withColumn(mark, F.lit(value).cast(train.schema[mark].dataType)),
        allowMissingColumns=True,
    )
