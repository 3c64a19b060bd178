"""Label codes, one-hot columns, token counts and crosses, in long form.

Long rows (key, feature, index, value) are the coordinates of the design matrix: they
need no vocabulary on the driver and no limit on the number of levels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.functions.joins import is_small, key_hash, lookup_all
from cohortloom.functions.ordering import positions
from cohortloom.functions.tokens import join_values
from cohortloom.operators.tokens import token_rows
from cohortloom.session import settle


def _as_number(value: Column) -> Column:
    return value.try_cast("long")


def fit_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, val, index): levels in sorted order, numbered from 0.

    A column whose levels are all whole numbers is sorted as numbers, any other as text.
    All columns are done in one pass, and no column's levels meet in one task.
    """
    levels = settle(
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "feature", "val")
        .filter(F.col("val").isNotNull())
        .distinct()
    )
    # one row per column name: bounded by the width of the table
    kinds = levels.groupBy("feature").agg(F.every(_as_number(F.col("val")).isNotNull()).alias("numeric"))
    number = F.when(F.col("numeric"), _as_number(F.col("val")))
    # spellings of one number ('7', '07') share its code
    typed = (
        levels.join(F.broadcast(kinds), "feature")
        .groupBy("feature", number.alias("_number"), F.when(~F.col("numeric"), F.col("val")).alias("_text"))
        .agg(F.collect_set("val").alias("_vals"))
    )
    ranked = positions(typed, ["feature"], ["_number", "_text"])
    return ranked.select(
        "feature", F.explode("_vals").alias("val"), (F.col("position") - 1).alias("index")
    )


def encode(df: DataFrame, codes: DataFrame, columns: Sequence[str], suffix: str = "_code") -> DataFrame:
    """Add one code column per category column; unseen levels get NULL."""
    text = df
    typed = [c for c in columns if df.schema[c].dataType.simpleString() != "string"]
    if typed:
        text = df.withColumns({c: F.col(c).cast("string") for c in typed})
    return lookup_all(text, codes, {c: [c] for c in columns}, ["val"], "index", suffix)


def one_hot_rows(encoded: DataFrame, keys: Sequence[str], columns: Sequence[str], suffix: str = "_code") -> DataFrame:
    """(keys, feature, index, value=1): every level is a column, none is dropped."""
    renamed = encoded.select(*keys, *[F.col(f"{c}{suffix}").alias(c) for c in columns])
    return (
        renamed.unpivot(list(keys), list(columns), "feature", "index")
        .filter(F.col("index").isNotNull())
        .withColumn("value", F.lit(1.0))
    )


def fit_vocabulary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, val, index): lower-case tokens in alphabetical order, numbered from 0."""
    tokens = (
        token_rows(df, [], columns, lower=True)
        .select("feature", F.col("token").alias("val")).distinct()
    )
    return positions(tokens, ["feature"], ["val"]).select(
        "feature", "val", (F.col("position") - 1).alias("index")
    )


def token_counts(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, feature, token, n): counted before the vocabulary is looked up.

    Texts are moved by their keys and split where they are counted, so what is moved is as
    long as the texts. Parts stay as small as the session's shuffles make them: put together
    by the bytes of their texts, they would have far more tokens than a task should count.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = F.array(*[F.struct(F.lit(c).alias("feature"), F.lower(c).alias("text")) for c in columns])
    moved = df.select(*keys, *[F.col(c).cast("string").alias(c) for c in columns if c not in keys]).repartition(parts, *keys)
    long = moved.select(*keys, F.inline(texts)).select(*keys, "feature", F.explode(F.split("text", " ")).alias("token"))
    return long.groupBy(*keys, "feature", "token").agg(F.count(F.lit(1)).alias("n"))


def token_count_rows(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], vocabulary: DataFrame
) -> DataFrame:
    """(keys, feature, index, value): token counts as matrix coordinates.

    The vocabulary is written once and broadcast if it is small: then the counts stay where
    they are.
    """
    counts = token_counts(df, keys, columns)
    listed = settle(vocabulary.select("feature", F.col("val").alias("token"), "index"))
    on = ["feature", "token"]
    if is_small(listed):
        met = counts.join(F.broadcast(listed), on)
    else:
        # hot tokens are one row per document here, and adaptive execution splits them
        met = counts.withColumn("_hash", key_hash(on)).join(listed.withColumn("_hash", key_hash(on)), ["_hash", *on])
    return met.select(*keys, "feature", "index", F.col("n").cast("double").alias("value"))


def matrix_rows(blocks: DataFrame, widths: DataFrame, order: Sequence[str]) -> DataFrame:
    """Blocks side by side: the index of a feature is moved behind the features before it.

    ``widths`` has one row per feature (feature, width): bounded by the table's width.
    """
    size = {r["feature"]: r["width"] for r in widths.select("feature", "width").collect()}
    start, offset = F.when(F.lit(False), F.lit(0).cast("long")), 0
    for feature in order:
        start = start.when(F.col("feature") == feature, F.lit(offset).cast("long"))
        offset += size.get(feature, 0)
    keys = [c for c in blocks.columns if c not in ("feature", "index", "value")]
    return blocks.select(*keys, (F.col("index") + start).alias("column"), "value")


def widths(dictionary: DataFrame) -> DataFrame:
    return dictionary.groupBy("feature").agg(F.count(F.lit(1)).alias("width"))


def pair_names(columns: Sequence[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]


def cross_pairs(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """All pairs of columns as ``<a>X<b>``, in one projection."""
    return df.select(*keys, *[join_values(a, b).alias(f"{a}X{b}") for a, b in pair_names(columns)])


def leaf_rows(scored: DataFrame, keys: Sequence[str], leaf: str = "leaf") -> DataFrame:
    """(keys, tree, leaf): the leaf a row falls into, one row per tree."""
    return scored.select(
        *keys, F.posexplode(vector_to_array(F.col(leaf))).alias("tree", "_leaf")
    ).select(*keys, F.col("tree").cast("long").alias("tree"), F.col("_leaf").cast("long").alias("leaf"))


def leaf_one_hot(leaves: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One-hot of the leaves, tree by tree: (keys, feature, index, value)."""
    named = leaves.withColumn("feature", F.concat(F.lit("tree"), "tree"))
    used = named.select("feature", "leaf").distinct()
    # trees times leaves: bounded by the shape of the model
    codes = positions(used, ["feature"], ["leaf"]).select(
        "feature", "leaf", (F.col("position") - 1).alias("index")
    )
    return named.join(F.broadcast(codes), ["feature", "leaf"]).select(
        *keys, "feature", "index", F.lit(1.0).alias("value")
    )
