"""Mixing sources to target weights by a random order and exact cuts.

Every document gets a random key that only its id decides. Within a source the documents
are ordered by that key: the key's range is cut into buckets of about ``bucket_rows``
documents, the sizes of the buckets are summed ahead of each bucket, and a window inside
the bucket does the rest, so that a source with a third of all rows is as many tasks as
its buckets. A source is taken whole as often as its target holds it; of the next round
it gives the documents whose middle word lies before the cut.

Sources are weighed by their place (code point order, null last). Targets are the fill
``min(limit * size, weight * level)`` whose sum is the sum of all sizes. Null and empty
texts have size 0 and are taken 0 words; a source without words has target 0. Documents
with equal ids in one source share a key and follow in order of size; rows equal in id and
size are taken alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortloom.functions.ordering import positions
from cohortloom.llm.common import Written, n_words

WEIGHTS = (5, 2, 1)
MOST = 3
BUCKET_ROWS = 4_096


def source_targets(sources: DataFrame, most: int) -> DataFrame:
    """Add ``target`` to (source, source_size, weight), one row per source.

    The level rises until no source stands above its limit: each round is one sum over
    the sources, and only that sum reaches the driver.
    """
    level = 0.0
    while True:
        full = F.col("source_size") * most <= F.col("weight") * F.lit(level)
        total, used, weight = sources.agg(
            F.sum("source_size"),
            F.sum(F.when(full, F.col("source_size") * most)),
            F.sum(F.when(~full, F.col("weight"))),
        ).first()
        if not weight:
            break
        raised = ((total or 0) - (used or 0)) / weight
        if raised <= level:
            break
        level = raised
    share = F.col("weight") * F.lit(level)
    limit = (F.col("source_size") * most).cast("double")
    return sources.withColumn("target", F.round(F.least(limit, share), 6))


def order_key(id_column: Column) -> Column:
    """The random place of a document: a hash of its id."""
    return F.md5(F.coalesce(id_column.cast("string"), F.lit("")))


def source_cuts(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """(source, source_size, target, rounds, cut) from (doc_id, source, size, key).

    ``cut`` is the last (key, doc_id, size) that the unfinished round takes, null for none.
    """
    keep = Written(sized.sparkSession)
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    placed = positions(sources, [], ["source"])
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("position") - 1) % len(weights) + 1).cast("int"))
    targets = source_targets(keep(placed.withColumn("weight", weight)), most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = keep(targets.withColumn("rounds", F.least(whole, F.lit(most)).cast("long")))

    # the first 32 bits of the key, as a share of their range, pick the bucket
    share = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    bucket = F.floor(share * F.ceil(F.col("n_rows") / F.lit(bucket_rows)))
    rest = F.col("target") - F.col("rounds") * F.col("source_size")
    named = targets.select(F.col("source").alias("_source"), "n_rows", rest.alias("rest"))
    rows = sized.join(named, sized["source"].eqNullSafe(F.col("_source"))).select(
        "source", "doc_id", "size", "key", "rest", bucket.alias("bucket")
    )
    # dealt by bucket, or the join's partitions by source would serve the window and stay whole
    rows = rows.repartition("source", "bucket")
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")).select(
        F.col("source").alias("_source"), F.col("bucket").alias("_bucket"),
        F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("ahead"),
    )
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size")
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ordered = rows.withColumn("before", upto - F.col("size")).join(
        ahead, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket"))
    )
    taken = ordered.filter(F.col("ahead") + F.col("before") + F.col("size") / 2 <= F.col("rest"))
    cuts = taken.groupBy(F.col("source").alias("_source")).agg(F.max(F.struct("key", "doc_id", "size")).alias("cut"))
    return targets.join(cuts, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "source", "source_size", "target", "rounds", "cut"
    )


def _with_copies(rows: DataFrame, cuts: DataFrame, most: int) -> DataFrame:
    """Add source_size, target and copies to rows that hold source, doc_id, size and key."""
    named = cuts.select(F.col("source").alias("_source"), "source_size", "target", "rounds", "cut")
    once_more = F.when(F.struct("key", "doc_id", "size") <= F.col("cut"), 1).otherwise(0)
    copies = F.least(F.col("rounds") + once_more, F.lit(most)).cast("long")
    return rows.join(named, rows["source"].eqNullSafe(F.col("_source"))).withColumn("copies", copies).drop(
        "_source", "rounds", "cut"
    )


def sizes(documents: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    return documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(source_column).cast("string").alias("source"),
        n_words(F.col(text_column)).alias("size"),
        order_key(F.col(id_column)).alias("key"),
    )


def mix(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken), one row per document."""
    sized = Written(documents.sparkSession)(sizes(documents, id_column, text_column, source_column))
    cuts = source_cuts(sized, weights, most, bucket_rows)
    taken = (F.col("copies") * F.col("size")).cast("long").alias("taken")
    return _with_copies(sized, cuts, most).select("doc_id", "source", "size", "source_size", "target", "copies", taken)


def mixed_documents(documents: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix itself: each document as many times as it is taken, with its own columns."""
    keep = Written(documents.sparkSession)
    cuts = source_cuts(keep(sizes(documents, "doc_id", "text", "source")), weights, most)
    names = documents.columns
    rows = documents.select(
        F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        n_words(F.col("text")).alias("size"),
        order_key(F.col("doc_id")).alias("key"),
    )
    copies = F.array_repeat(F.lit(1), F.col("copies").cast("int"))
    return _with_copies(rows, cuts, most).select("row", F.explode(copies).alias("copy")).select("row.*")
