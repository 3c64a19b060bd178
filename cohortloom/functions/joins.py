"""Lookups on unique keys, with the size of the table counted before it is broadcast."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from cohortloom.session import settle

# What may be broadcast by all lookups of one job together.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 128 << 20

# Bytes of a hashed row besides its text.
_ROW_BYTES = 64


def row_bytes(columns: Sequence[str]) -> Column:
    """Rough size of a row in a broadcast table: its text plus a fixed part."""
    text = F.concat_ws("", *[F.col(c).cast("string") for c in columns])
    return F.octet_length(text).cast("long") + F.lit(_ROW_BYTES)


def key_hash(columns: Sequence[str]) -> Column:
    """A number that goes before the keys of a join.

    Sorting compares it first: keys of many features begin alike, and the numbers do not. The keys
    themselves stay in the join, so equal numbers make nothing equal.
    """
    return F.xxhash64(*columns)


def measure(table: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows and bytes of a lookup table; a double key is an error, it would multiply rows."""
    sizes = (
        table.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(table.columns)).alias("size"))
        .agg(F.sum("n").alias("n_rows"), F.max("n").alias("deepest"), F.sum("size").alias("size"))
        .first()
    )
    if (sizes["deepest"] or 0) > 1:
        raise ValueError(f"lookup keys {list(keys)} are not unique")
    return sizes["n_rows"] or 0, sizes["size"] or 0


def is_small(table: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a written table may be broadcast; nothing is moved to see it."""
    found = table.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(table.columns)).alias("size")).first()
    return found["n"] <= broadcast_rows and (found["size"] or 0) <= BROADCAST_BYTES


def lookup(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Left join on unique keys.

    The table is written once and measured. Within the limits it is broadcast and ``rows``
    is not shuffled; beyond them both sides are shuffled and adaptive execution splits hot
    keys.
    """
    table = settle(table)
    n_rows, size = measure(table, keys)
    if n_rows <= broadcast_rows and size <= BROADCAST_BYTES:
        table = F.broadcast(table)
    return rows.join(table, list(keys), "left")


def _double(tables: DataFrame, keys: Sequence[str]) -> list[str]:
    """Features of a long table with a double key.

    Hashes of the keys are counted, so that their text is not moved; only if two rows share
    one are the keys themselves compared.
    """
    hashes = tables.groupBy(key_hash(keys).alias("__hash")).agg(F.count(F.lit(1)).alias("n"))
    if (hashes.agg(F.max("n").alias("deepest")).first()["deepest"] or 0) < 2:
        return []
    # one row per feature name
    found = tables.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("feature").distinct()
    return sorted(r["feature"] for r in found.collect())


def lookup_all(
    rows: DataFrame,
    tables: DataFrame,
    keys: Mapping[str, Sequence[str]],
    stored: Sequence[str],
    value: str,
    suffix: str,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Many lookups from one long table (feature, <stored keys>, value).

    ``keys[feature]`` names the columns of ``rows`` that stand for the stored key
    columns. The long table is written once and its features are measured in one
    small job; the smallest ones are broadcast until the budget of rows or bytes is
    used up, the others are joined together.
    """
    tables = settle(tables.select("feature", *stored, value))
    double = _double(tables, ["feature", *stored])
    if double:
        raise ValueError(f"lookup keys are not unique for {double}")
    # one row per feature name
    sizes = {
        r["feature"]: r
        for r in tables.groupBy("feature")
        .agg(F.count(F.lit(1)).alias("n_keys"), F.sum(row_bytes(stored)).alias("size"))
        .collect()
    }
    left, left_bytes = broadcast_rows, BROADCAST_BYTES
    order, columns = sorted(keys, key=lambda f: sizes[f]["n_keys"] if f in sizes else 0), list(rows.columns)
    long: list[str] = []
    for feature in order:
        n_keys, size = (sizes[feature]["n_keys"], sizes[feature]["size"]) if feature in sizes else (0, 0)
        if n_keys > left or size > left_bytes:
            long.append(feature)
            continue
        left, left_bytes = left - n_keys, left_bytes - size
        wanted = [k for k in stored[: len(keys[feature])]]
        part = tables.filter(F.col("feature") == feature).select(
            *[F.col(s).alias(f"_{s}") for s in wanted], F.col(value).alias(f"{feature}{suffix}")
        )
        match = [rows[c] == F.col(f"_{s}") for s, c in zip(wanted, keys[feature])]
        rows = rows.join(F.broadcast(part), match, "left").drop(*[f"_{s}" for s in wanted])
    if long:
        rows = _looked_up_together(rows, tables, {f: keys[f] for f in long}, stored, value, suffix)
    return rows.select(*columns, *[f"{f}{suffix}" for f in order])


def _looked_up_together(
    rows: DataFrame, tables: DataFrame, keys: Mapping[str, Sequence[str]], stored: Sequence[str], value: str, suffix: str
) -> DataFrame:
    """The lookups past the budget: one join and one regrouping, whatever their number.

    Rows are written with a number of their own. Each stands once per feature in a long table,
    which meets the tables on (feature, keys); adaptive execution splits a hot key. What
    was found is brought back to its row by the number: a group is one row's own values.
    """
    rows = settle(rows.withColumn("__row", F.monotonically_increasing_id()))
    types = {f.name: f.dataType for f in tables.schema}

    def blank(s: str) -> Column:
        """What stands in both tables where a feature has no such key column."""
        return F.lit("" if isinstance(types[s], StringType) else 0).cast(types[s])

    places = {f: i for i, f in enumerate(keys)}

    def stood_for(feature: str) -> Column:
        """The keys of a feature as the table stores them."""
        used = dict(zip(stored, keys[feature]))
        made = [(F.col(used[s]).cast(types[s]) if s in used else blank(s)).alias(f"__{s}") for s in stored]
        return F.struct(F.lit(places[feature]).alias("__feature"), *made)

    met_on = ["__feature", *[f"__{s}" for s in stored]]
    wanted = rows.select("__row", F.inline(F.array(*[stood_for(f) for f in keys])))
    wanted = wanted.dropna(subset=[f"__{s}" for s in stored]).withColumn("__hash", key_hash(met_on))
    depth = place = F.when(F.lit(False), F.lit(0))
    for feature, columns in keys.items():
        depth = depth.when(F.col("feature") == feature, F.lit(len(columns)))
        place = place.when(F.col("feature") == feature, F.lit(places[feature]))
    part = tables.filter(F.col("feature").isin(list(keys))).select(
        place.alias("__feature"), value,
        *[
            F.when(depth > i, F.col(s)).otherwise(blank(s)).alias(f"__{s}") for i, s in enumerate(stored)
        ],
    ).withColumn("__hash", key_hash(met_on))
    met = wanted.join(part, ["__hash", *met_on]).select("__row", "__feature", value)
    # hardly two values of a row are in one task before they are moved: nothing to combine there
    found = met.repartition("__row").groupBy("__row").agg(
        *[F.max(F.when(F.col("__feature") == places[f], F.col(value))).alias(f"{f}{suffix}") for f in keys]
    )
    return rows.join(found, "__row", "left").drop("__row")


def join_audit(rows: DataFrame, table: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """What a left join would do, without doing it: one row of counts.

    Both sides are reduced to one row per key first, so a key that holds most of
    the rows costs no more than any other.
    """
    left = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_left"))
    right = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_right"))
    both = left.join(right, list(keys), "full")
    n_left = F.coalesce(F.col("n_left"), F.lit(0))
    n_right = F.coalesce(F.col("n_right"), F.lit(0))
    return both.agg(
        F.lit(name).alias("lookup"),
        F.sum(n_left).alias("rows_before"),
        F.sum(n_left * F.greatest(n_right, F.lit(1))).alias("rows_after"),
        F.sum(F.when(n_right == 0, n_left).otherwise(0)).alias("unmatched_rows"),
        F.sum(F.when(n_right > 1, 1).otherwise(0)).alias("double_keys"),
    )
