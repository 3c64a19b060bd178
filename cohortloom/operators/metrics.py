"""Exact ranking metrics: area under the ROC curve and best F1, with ties.

Rows are first added up per distinct score, then put in order range by range, so
neither a score shared by a third of the rows nor a metric over all rows needs a
single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.functions.ordering import running_totals
from cohortloom.functions.scalars import ratio


def _per_score(scored: DataFrame, by: Sequence[str], label: str, score: str, weight: str | None = None) -> DataFrame:
    known = scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    positive = F.col(label) == 1

    def number(of: Column) -> Column:
        return F.coalesce(F.sum(F.when(of, F.col(weight))), F.lit(0)) if weight else F.count(F.when(of, 1))

    return known.groupBy(*by, F.col(score).alias("score")).agg(number(positive).alias("pos"), number(~positive).alias("neg"))


def pairs_won(pos: str, neg: str) -> Column:
    """Pairs a score wins: its positives over all lower negatives, ties half."""
    below = F.col(f"{neg}_upto") - F.col(neg)
    return F.col(pos).cast("double") * (below.cast("double") + F.col(neg) / F.lit(2.0))


def roc_auc(
    scored: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score", weight: str | None = None
) -> DataFrame:
    """(by, positives, negatives, auc); NULL where one of the classes is missing.

    ``weight`` names a column that says how many rows a row stands for.
    """
    ordered = running_totals(_per_score(scored, by, label, score, weight), by, ["score"], ["pos", "neg"])
    totals = ordered.groupBy(*by).agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
        F.sum(pairs_won("pos", "neg")).alias("_won"),
    )
    possible = F.col("positives").cast("double") * F.col("negatives")
    return totals.withColumn("auc", ratio(F.col("_won"), possible)).drop("_won")


def best_f1(
    scored: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score"
) -> DataFrame:
    """(by, name, f1, threshold, higher_is_better): the best F1 over all thresholds.

    A threshold accepts every score at or above it; of equally good ones the lowest is
    reported. Without any positive the best is 0.
    """
    ordered = running_totals(
        _per_score(scored, by, label, score), by, ["score"], ["pos", "neg"], descending=["score"]
    )
    accepted = F.col("pos_upto") + F.col("neg_upto")
    f1 = F.coalesce(ratio(2 * F.col("pos_upto"), accepted + F.col("pos_all")), F.lit(0.0))
    best = F.max(F.struct(f1.alias("f1"), (-F.col("score")).alias("_low")))
    return ordered.groupBy(*by).agg(best.alias("_best")).select(
        *by,
        F.lit("f1_score").alias("name"),
        F.col("_best.f1").alias("f1"),
        (-F.col("_best._low")).alias("threshold"),
        F.lit(True).alias("higher_is_better"),
    )
