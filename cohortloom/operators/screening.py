"""Feature screens without a fit per feature: every candidate is judged in one pass.

A candidate is scored by the click rate its levels had in training; the area under the
curve on both parts says what it adds. Models are fitted only for what is left.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from cohortloom.functions.dominance import RANGE_ROWS, dominated
from cohortloom.functions.ordering import running_totals
from cohortloom.functions.scalars import ratio
from cohortloom.operators.metrics import pairs_won
from cohortloom.operators.rates import key_names, keyed_rows, labelled
from cohortloom.operators.tokens import rank_tokens, token_rows
from cohortloom.session import settle
from cohortloom.sources.schemas import MISSING

# Rows whose levels a task of the screen counts before they meet.
PART_ROWS = 250_000
_COUNTS = ["train_pos", "train_neg", "valid_pos", "valid_neg"]


def _split_counts(split: str = "is_train") -> list:
    train, click = F.col(split) == 1, F.col("label") == 1
    return [
        F.count(F.when(train & click, 1)).alias("train_pos"),
        F.count(F.when(train & ~click, 1)).alias("train_neg"),
        F.count(F.when(~train & click, 1)).alias("valid_pos"),
        F.count(F.when(~train & ~click, 1)).alias("valid_neg"),
    ]


def _two_aucs(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """AUC_0 (training) and AUC_1 (validation) from counts per (by, score)."""
    ordered = running_totals(counts, by, ["score"], _COUNTS)
    sums = ordered.groupBy(*by).agg(
        *[F.sum(c).cast("double").alias(c) for c in _COUNTS],
        F.sum(pairs_won("train_pos", "train_neg")).alias("_won_0"),
        F.sum(pairs_won("valid_pos", "valid_neg")).alias("_won_1"),
    )
    return sums.select(
        *by,
        ratio(F.col("_won_0"), F.col("train_pos") * F.col("train_neg")).alias("AUC_0"),
        ratio(F.col("_won_1"), F.col("valid_pos") * F.col("valid_neg")).alias("AUC_1"),
    )


def screen_features(
    samples: DataFrame, features: Mapping[str, Sequence[str]], split: str = "is_train", part_rows: int = PART_ROWS
) -> DataFrame:
    """(var_name, AUC_0, AUC_1) for each feature, a feature being one or more columns.

    Levels without a training row get the overall training rate.
    """
    names = key_names(features)
    used = sorted({c for columns in features.values() for c in columns} | {"label", split})
    rows = settle(labelled(samples).select(*used, F.monotonically_increasing_id().alias("_row")))
    # dealt by number: a task's levels are those of so many rows, however many there are
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // part_rows))
    levels = (
        keyed_rows(rows.repartition(parts, "_row"), features, ["label", split])
        .groupBy("feature", *names).agg(*_split_counts(split))
    )
    # every row counts once for each feature, so all features have one rate: one row
    overall = rows.agg(*_split_counts(split)).select(
        ratio(F.col("train_pos"), F.col("train_pos") + F.col("train_neg")).alias("_overall")
    )
    own = ratio(F.col("train_pos"), F.col("train_pos") + F.col("train_neg"))
    scored = (
        levels.crossJoin(F.broadcast(overall))
        .groupBy(F.col("feature").alias("var_name"), F.coalesce(own, "_overall").alias("score"))
        .agg(*[F.sum(c).alias(c) for c in _COUNTS])
    )
    return _two_aucs(scored, ["var_name"])


def cut_search(samples: DataFrame, column: str, cuts: Sequence[int], split: str = "is_train") -> DataFrame:
    """For each number of kept tokens: (kept, cut_num, coverage, AUC_0, AUC_1).

    Tokens are ranked by how often they occur; a kept token is scored by its own training
    rate, all others share one. Only the kept tokens are repeated per cut, so the work
    past the token counts depends on the cuts and not on the vocabulary.
    """
    tokens = token_rows(labelled(samples), ["label", split], [column])
    counted = (
        tokens.filter(F.col("token") != MISSING).groupBy("feature", "token").agg(*_split_counts(split))
    )
    total = sum((F.col(c) for c in _COUNTS), F.lit(0))
    ranked = rank_tokens(counted.withColumn("importance", total.cast("double")))
    # as many rows as there are cuts
    cut = samples.sparkSession.createDataFrame(
        [(column, int(n)) for n in cuts], "feature string, kept long"
    )
    # kept tokens and, for each cut, one row with what they leave over
    steps = F.array(*[F.lit(int(n)).cast("long") for n in cuts])
    kept = (
        ranked.filter(F.col("position") <= max(cuts))
        .select("feature", "position", *_COUNTS, F.explode(steps).alias("kept"))
        .filter(F.col("position") <= F.col("kept"))
    )
    whole = ranked.groupBy("feature").agg(*[F.sum(c).alias(f"{c}_whole") for c in _COUNTS])
    sums = kept.groupBy("feature", "kept").agg(*[F.sum(c).alias(f"{c}_kept") for c in _COUNTS])
    # both are bounded by the cuts and the one feature
    left_over = (
        cut.join(sums, ["feature", "kept"], "left")
        .join(whole, "feature")
        .select(
            "kept",
            *[(F.col(f"{c}_whole") - F.coalesce(F.col(f"{c}_kept"), F.lit(0))).alias(c) for c in _COUNTS],
            (
                1 - ratio(
                    sum((F.col(f"{c}_whole") - F.coalesce(F.col(f"{c}_kept"), F.lit(0)) for c in _COUNTS), F.lit(0)),
                    sum((F.col(f"{c}_whole") for c in _COUNTS), F.lit(0)),
                )
            ).alias("coverage"),
        )
    )
    own = F.coalesce(ratio(F.col("train_pos"), F.col("train_pos") + F.col("train_neg")), F.lit(0.0))
    counts = (
        kept.select("kept", *_COUNTS).unionByName(left_over.drop("coverage"))
        .groupBy("kept", own.alias("score")).agg(*[F.sum(c).alias(c) for c in _COUNTS])
    )
    return _two_aucs(counts, ["kept"]).join(left_over.select("kept", "coverage"), "kept").select(
        "kept", (F.col("kept") + 1).alias("cut_num"), "coverage", "AUC_0", "AUC_1"
    )


def cut_curve(samples: DataFrame, column: str, split: str = "is_train", range_rows: int = RANGE_ROWS) -> DataFrame:
    """(kept, cut_num, coverage, AUC_0, AUC_1) for every number of kept tokens, from 1 to all.

    From one cut to the next one token leaves the shared bucket for a score of its own. So
    pairs won among kept tokens grow by those of the new token against the tokens
    before it, and the bucket meets the kept ones by its own rate: two sums over
    tokens of a lower rank and a lower (or equal) score. Ranks and scores are put in order range by
    range, so the work is near linear in the tokens and no task sees all of them.
    """
    counted = (
        token_rows(labelled(samples), ["label", split], [column])
        .filter(F.col("token") != MISSING).groupBy("feature", "token").agg(*_split_counts(split))
    )
    total = sum((F.col(c) for c in _COUNTS), F.lit(0))
    ranked = rank_tokens(counted.withColumn("importance", total.cast("double"))).select("position", *_COUNTS)

    def rate(pos, neg):
        return F.coalesce(ratio(pos, pos + neg), F.lit(0.0))

    rest = {c: F.col(f"{c}_all") - F.col(f"{c}_upto") for c in _COUNTS}
    tokens = settle(
        running_totals(ranked, [], ["position"], _COUNTS)
        .withColumn("own", rate(F.col("train_pos"), F.col("train_neg")))
        .withColumn("shared", rate(rest["train_pos"], rest["train_neg"]))
    )
    # a score's place: behind all tokens with a lower one (low), or with an equal one too (high)
    marks = F.array(
        F.struct(F.col("own").alias("score"), F.lit(1).alias("kind"), F.lit("token").alias("asks")),
        *[
            F.struct(F.col(score).alias("score"), F.lit(kind).alias("kind"), F.lit(f"{score}_{name}").alias("asks"))
            for score in ("own", "shared") for kind, name in ((0, "low"), (2, "high"))
        ],
    )
    placed = running_totals(
        tokens.select("position", *_COUNTS, F.inline(marks)).withColumn("here", (F.col("asks") == "token").cast("long")),
        [], ["score", "kind", "position", "asks"], ["here"],
    ).select(
        (F.col("here") == 1).alias("point"), F.col("position").alias("first"),
        F.col("here_upto").alias("second"), "asks", *_COUNTS,
    )
    sums = dominated(settle(placed), ["asks"], _COUNTS, range_rows)
    wide = sums.groupBy(F.col("first").alias("position")).agg(*[
        (F.sum(F.when(F.col("asks").startswith(score), F.col(c))) / 2).alias(f"{score}_{c}")
        for score in ("own", "shared") for c in _COUNTS
    ])
    met = tokens.join(wide, "position")

    def won(pos: str, neg: str, score: str, mine_pos, mine_neg):
        """Pairs of a score's rows with those of the tokens up to here, ties half."""
        above = F.col(f"{pos}_upto") - F.col(f"{score}_{pos}")
        return mine_pos * F.col(f"{score}_{neg}") + mine_neg * above

    parts = {"0": ("train_pos", "train_neg"), "1": ("valid_pos", "valid_neg")}
    steps = met.select(
        "*",
        *[
            (won(p, n, "own", F.col(p), F.col(n)) - F.col(p).cast("double") * F.col(n) / 2).alias(f"step_{k}")
            for k, (p, n) in parts.items()
        ],
        *[
            (won(p, n, "shared", rest[p], rest[n]) + rest[p].cast("double") * rest[n] / 2).alias(f"bucket_{k}")
            for k, (p, n) in parts.items()
        ],
    )
    grown = running_totals(steps, [], ["position"], ["step_0", "step_1"])
    aucs = [
        ratio(F.col(f"step_{k}_upto") + F.col(f"bucket_{k}"), F.col(f"{p}_all").cast("double") * F.col(f"{n}_all")).alias(f"AUC_{k}")
        for k, (p, n) in parts.items()
    ]
    left_over = ratio(sum(rest.values(), F.lit(0)), sum((F.col(f"{c}_all") for c in _COUNTS), F.lit(0)))
    return grown.select(
        F.col("position").alias("kept"), (F.col("position") + 1).alias("cut_num"), (1 - left_over).alias("coverage"), *aucs
    )
