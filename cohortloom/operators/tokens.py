"""Token columns in long form: ranking by importance and collapsing the rare ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.functions.joins import BROADCAST_BYTES, BROADCAST_ROWS, measure
from cohortloom.functions.ordering import positions
from cohortloom.functions.tokens import OTHER, replace_tokens
from cohortloom.session import settle
from cohortloom.sources.schemas import MISSING, TOKENS_KEPT

# Rare tokens that may be written into an expression as literals.
LITERAL_TOKENS = 5_000
LITERAL_BYTES = 1 << 20


def token_rows(df: DataFrame, keys: Sequence[str], columns: Sequence[str], lower: bool = False) -> DataFrame:
    """(keys, feature, place, token), one row per token; the whole text is read."""
    long = df.unpivot(list(keys), list(columns), "feature", "text")
    text = F.lower("text") if lower else F.col("text")
    return long.select(*keys, "feature", F.posexplode(F.split(text, " ")).alias("place", "token"))


def token_importance(df: DataFrame, columns: Sequence[str], lower: bool = False) -> DataFrame:
    """Occurrences per (feature, token), the stand-in where no importance table is given."""
    return (
        token_rows(df, [], columns, lower)
        .groupBy("feature", "token")
        .agg(F.count(F.lit(1)).cast("double").alias("importance"))
    )


def rank_tokens(importance: DataFrame) -> DataFrame:
    """Add ``position`` per feature by falling importance; ties go by the token.

    The mark for "no tokens" takes no part.
    """
    return positions(
        importance.filter(F.col("token") != MISSING),
        ["feature"], ["importance", "token"], descending=["importance"],
    )


def _limit(kept: Mapping[str, int]) -> Column:
    """Tokens kept for the feature of a row; NULL for a feature that keeps all."""
    limit = F.when(F.lit(False), 0)
    for feature, n in kept.items():
        limit = limit.when(F.col("feature") == feature, F.lit(n))
    return limit


def rare_tokens(ranked: DataFrame, kept: Mapping[str, int]) -> DataFrame:
    """Everything after the top N of its feature."""
    return ranked.filter(F.col("position") > _limit(kept))


def nth_token(ranked: DataFrame, n: Mapping[str, int]) -> DataFrame:
    """The first token that falls away when ``n`` are kept."""
    return ranked.filter(F.col("position") == _limit(n) + 1)


def collapse_rare(
    df: DataFrame,
    keys: Sequence[str],
    rare: DataFrame,
    columns: Sequence[str],
    literal_tokens: int = LITERAL_TOKENS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Replace the rare tokens of each column by 'other'; returns keys and columns.

    Every row of ``df`` comes back once, whatever its keys and texts; NULL stays NULL. A
    short list goes into the projection and nothing moves. A long one is joined on
    (feature, token), broadcast only up to its counted limit; the rows are written with a
    number of their own, by which their tokens are put back in their places: a group is
    one row's own text, never more.
    """
    rare = settle(rare.select("feature", "token"))
    n_rare, size = measure(rare, ["feature", "token"])
    if n_rare <= literal_tokens and size <= LITERAL_BYTES:
        listed: dict[str, list[str]] = {c: [] for c in columns}
        for row in rare.collect():
            if row["feature"] in listed:
                listed[row["feature"]].append(row["token"])
        return df.select(*keys, *[replace_tokens(F.col(c), listed[c]).alias(c) for c in columns])

    marked = rare.withColumn("_rare", F.lit(True))
    if n_rare <= broadcast_rows and size <= BROADCAST_BYTES:
        marked = F.broadcast(marked)
    rows = settle(df.select(*keys, *columns).withColumn("_row", F.monotonically_increasing_id()))
    tokens = token_rows(rows, ["_row"], columns).join(marked, ["feature", "token"], "left")
    token = F.when(F.col("_rare"), OTHER).otherwise(F.col("token"))
    placed = tokens.select("_row", "feature", F.struct("place", token.alias("token")).alias("_at"))

    def text(column: str) -> Column:
        mine = F.array_sort(F.collect_list(F.when(F.col("feature") == column, F.col("_at"))))
        return F.when(
            F.size(mine) > 0, F.array_join(F.transform(mine, lambda x: x["token"]), " ")
        ).alias(column)

    texts = placed.groupBy("_row").agg(*[text(c) for c in columns])
    return rows.select("_row", *keys).join(texts, "_row", "left").select(*keys, *columns)


def keep_top(
    df: DataFrame, keys: Sequence[str], importance: DataFrame, kept: Mapping[str, int] = TOKENS_KEPT
) -> DataFrame:
    """All token columns at once: the top N of each stay, the rest become 'other'.

    N is clamped to the number of tokens by itself: past the last rank nothing is rare.
    """
    columns = [c for c in kept if c in df.columns]
    rare = rare_tokens(rank_tokens(importance), {c: kept[c] for c in columns})
    return collapse_rare(df, keys, rare, columns)
