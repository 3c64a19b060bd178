"""How five filters act in every order: removal steps as a min-plus product.

A document is reduced to the set of filters it fails. With M(m, f) = 0 where mask m fails
filter f and infinity elsewhere, and P(o, f) the place of filter f in order o (the inverse
of the permutation), the step at which order o removes mask m is the min-plus product

    R(o, m) = min over f of M(m, f) + P(o, f),

infinity if it is kept. Everything reported is a scatter of the documents counted per mask
over R: by step for what is removed, behind R for what a filter would have removed again.

Only counts move. Rows are counted per (text, part, labels) before they meet: copies of a
text fail the same filters but one, and that one, "a smaller doc_id has the same text", is
decided from the smallest doc_id per counted row. A text of a third of all rows, or a part,
is combined map-side. What reaches a group of Python is at most 128 rows per part.

Odd input: null text is the empty text, equal to other empty ones; a null doc_id is no
smaller and no greater than any other, so its row is no copy; rows repeated under one doc_id are not
copies of each other and count each; null source is the part ''; labels repeated for a
doc_id count once, if any of them is 1; texts are read whole by built-in functions; clashing
columns are not read; without documents there is no part and no row.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cohortloom.llm.common import WORD

FILTERS = "ABCDE"
WEIGHTS = ["n", "good", "toxic"]
RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def failed_by_text(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, mask): bits 0 to 3 of the mask are the filters A to D."""
    text = F.coalesce("text", F.lit(""))
    found = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"))
    words = found.select(
        "doc_id", "part", "text", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words")
    ).select(
        "doc_id", "part", "text", F.size("words").cast("long").alias("n_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
    )
    fails = [
        F.col("n_words") < 50,
        100 * F.col("n_distinct") < 65 * F.col("n_words"),
        100 * F.regexp_count("text", F.lit("[A-Z]")).cast("long") > 5 * F.length("text").cast("long"),
        F.col("text").rlike("[#$%&*|]"),
    ]
    mask = sum((f.cast("int") * (1 << i) for i, f in enumerate(fails)), F.lit(0))
    return words.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per set of failed filters, bit 4 for copies."""
    marks = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"),
    )
    # equal rows first, so that the number of rows at the smallest doc_id is known below
    rows = failed_by_text(docs).groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    marked = rows.join(marks, "doc_id", "left").na.fill(0, ["good", "toxic"])
    # a null doc_id is no copy: it is counted apart
    per_text = marked.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNotNull(), F.col("n"))), F.lit(0)).alias("named"),
        F.min("doc_id").alias("least"),
        F.coalesce(F.min_by(F.when(F.col("doc_id").isNotNull(), F.col("n")), "doc_id"), F.lit(0)).alias("n_least"),
    )
    first = per_text.groupBy("digest").agg(F.min("least").alias("first"))
    own = F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0) + F.col("nameless")
    judged = per_text.join(first, "digest").select(
        "part", "mask", "good", "toxic",
        F.coalesce(own, F.col("nameless")).alias("own"), (F.col("named") + F.col("nameless")).alias("all"),
    )
    split = judged.select(
        "part", "good", "toxic",
        F.inline(F.array(
            F.struct(F.col("mask"), F.col("own").alias("n")),
            F.struct((F.col("mask") + 16).alias("mask"), (F.col("all") - F.col("own")).alias("n")),
        )),
    )
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
    )


def positions(n: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All orders of n filters, and the step (from 1) of each filter in each of them."""
    orders = list(permutations(range(n)))
    return orders, np.argsort(np.array(orders), axis=1) + 1


def min_plus(places: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """(orders, masks): the first step whose filter the mask fails; n + 1 for none."""
    n = places.shape[1]
    cost = np.where((masks[:, None] >> np.arange(n)) & 1, 0, n + 1)
    return np.minimum((places[:, None, :] + cost[None]).min(axis=2), n + 1)


def scattered(masks: np.ndarray, weights: np.ndarray, n: int = len(FILTERS)) -> dict[str, np.ndarray]:
    """Columns (orders x steps) from documents per mask; ``weights`` is (masks, 3)."""
    orders, places = positions(n)
    removal = min_plus(places, masks)
    steps = np.zeros((len(orders), n + 2, weights.shape[1]), np.int64)
    at = np.broadcast_to(np.arange(len(orders))[:, None], removal.shape)
    np.add.at(steps, (at, removal), np.broadcast_to(weights, (*removal.shape, weights.shape[1])))
    removed = steps[:, 1 : n + 1, 0]
    filters = np.array(orders)
    fails = ((masks[:, None] >> np.arange(n)) & 1).astype(bool)
    # failing the filter of a step, and gone before it
    gone = removal[:, None, :] < np.arange(1, n + 1)[None, :, None]
    redundant = ((fails.T[filters] & gone) * weights[:, 0]).sum(axis=2)
    unique = np.array([weights[masks == 1 << f, 0].sum() for f in range(n)])
    shapley = np.zeros(n, np.int64)
    np.add.at(shapley, filters, removed)
    return {
        "kept": weights[:, 0].sum() - removed.cumsum(axis=1), "removed": removed, "redundant": redundant,
        "unique_fails": unique[filters], "good_lost": steps[:, 1 : n + 1, 1],
        "toxic_lost": steps[:, 1 : n + 1, 2], "shapley": shapley[filters],
    }


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, zeros included."""
    orders, _ = positions(len(FILTERS))
    names = np.repeat(["".join(FILTERS[f] for f in o) for o in orders], len(FILTERS))
    steps = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(orders))

    def one_part(rows: pd.DataFrame) -> pd.DataFrame:
        found = scattered(rows["mask"].to_numpy(np.int64), rows[WEIGHTS].to_numpy(np.int64))
        columns = {k: v.reshape(-1) for k, v in found.items()}
        return pd.DataFrame({"part": rows["part"].iloc[0], "filter_order": names, "step": steps} | columns)

    return mask_counts(docs, labels).groupBy("part").applyInPandas(one_part, RESULT)
