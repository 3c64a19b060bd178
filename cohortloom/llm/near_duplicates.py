"""Near-duplicate documents by consistent weighted sampling over TF-IDF shingles.

A document is a weighted set: its runs of five lower-cased words, each weighing its count
times the mean inverse document frequency of its words. Document frequencies are counted
over all documents in a table of ``buckets`` counters (words by hash), whose size is a
parameter and does not grow, so that every task can hold it. Improved consistent weighted
sampling draws ``bands * rows`` samples of (shingle, step); two documents agree in a sample
with a chance equal to their weighted Jaccard similarity. Documents that agree in a whole
band are candidates and their similarity is then computed from the texts.

Documents with equal texts are one class from the start. Inside a bucket of a band not all
pairs are made. First every member is compared with the bucket's first member; the links
found join members to components. What is not yet in the component of the bucket's first
member goes on with another centre (the member with most links), and after that the
pairs that lie in different components and could still be similar by their total weights
are compared one by one, so no link that joins two components is lost.

A document with fewer than five words is one shingle. Null texts and texts without a word
have no shingles and are never linked; each id of such texts is a class of its own (no id
is one id). Repeated rows share a class. The class id is the smallest document id of the
class, null if all are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.llm.common import Written, arrow_types, map_rows
from cohortloom.llm.groups import components
from cohortloom.llm.tokens import combined, hashed_text, windows

SHINGLE = 5
SIMILAR = 0.8
BANDS = 16
ROWS = 6
BUCKETS = 1 << 18
# Further centres of a bucket before its open pairs are compared.
HUBS = 3
# Sets of random numbers that shingles are dealt to by hash.
DRAWS = 1 << 15
BLOCK = 1 << 13


def frequencies(texts: DataFrame, buckets: int = BUCKETS) -> tuple[np.ndarray, int]:
    """Documents per word bucket, and the number of documents; at most ``buckets`` rows."""
    schema = "bucket long, n long"
    kinds = arrow_types(texts.sparkSession, schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets + 1, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen = np.unique(hashed_text(text) % np.uint64(buckets)).astype(np.int64)
                counts[seen] += 1
            counts[buckets] += batch.num_rows
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, kinds["bucket"]), pa.array(counts[at], kinds["n"])], names=list(kinds))

    found = texts.mapInArrow(count, schema).groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets + 1, np.int64)
    counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return counts[:buckets], int(counts[buckets])


def inverse(counts: np.ndarray, n: int) -> np.ndarray:
    """Inverse document frequency of each bucket."""
    return (1.0 + np.log((n + 1.0) / (counts + 1.0))).astype(np.float32)


def weighted(text: str | None, idf: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a text in order of their hash, and their weights."""
    hashes = hashed_text(text)
    if not len(hashes):
        return hashes, np.empty(0)
    found = windows(hashes, shingle)
    word = np.append(0.0, np.cumsum(idf[(hashes % np.uint64(len(idf))).astype(np.int64)], dtype=np.float64))
    size = min(shingle, len(hashes))
    # the mean is rounded so that a shingle weighs the same wherever it stands
    mean = np.round((word[size:] - word[:-size]) / size, 4)
    distinct, first, n = np.unique(found, return_index=True, return_counts=True)
    return distinct, mean[first] * n


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.searchsorted(a[0], b[0])
    at[at == len(a[0])] = 0
    same = a[0][at] == b[0]
    least = np.minimum(a[1][at[same]], b[1][same]).sum()
    return float(least / (a[1].sum() + b[1].sum() - least))


class Sampler:
    """Improved consistent weighted sampling: r, c from Gamma(2, 1), b uniform."""

    def __init__(self, samples: int, draws: int = DRAWS, seed: int = 7) -> None:
        random = np.random.default_rng(seed)
        shape = (draws, samples)
        self.r = random.gamma(2.0, 1.0, shape).astype(np.float32)
        self.log_c = np.log(random.gamma(2.0, 1.0, shape)).astype(np.float32)
        self.b = random.random(shape).astype(np.float32)
        self.samples = samples

    def __call__(self, shingles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sampled shingle and step for each sample."""
        best = np.full(self.samples, np.inf, np.float32)
        shingle, step = np.zeros(self.samples, np.uint64), np.zeros(self.samples, np.int64)
        for lo in range(0, len(shingles), BLOCK):
            part = shingles[lo : lo + BLOCK]
            draw = (part % np.uint64(len(self.r))).astype(np.int64)
            r = self.r[draw]
            t = np.log(weights[lo : lo + BLOCK]).astype(np.float32)[:, None] / r
            t += self.b[draw]
            np.floor(t, out=t)
            # ln a = ln c - r (t - b) - r
            a = self.log_c[draw] - r * (t - self.b[draw] + 1)
            at = a.argmin(axis=0)
            columns = np.arange(self.samples)
            better = a[at, columns] < best
            best[better] = a[at, columns][better]
            shingle[better] = part[at[better]]
            step[better] = t[at, columns][better].astype(np.int64)
        return shingle, step


def signatures(texts: DataFrame, idf: Broadcast, bands: int, rows: int) -> DataFrame:
    """Band hashes and total weight of (id, text, digest); no bands for a text without words."""

    def sign(batch: pa.RecordBatch) -> dict[str, list]:
        sampler = _sampler(bands * rows)
        out: dict[str, list] = {"id": batch.column(0), "digest": batch.column(2), "bands": [], "weight": []}
        for text in batch.column(1).to_pylist():
            shingles, weights = weighted(text, idf.value)
            out["weight"].append(float(weights.sum()))
            if not len(shingles):
                out["bands"].append([])
                continue
            shingle, step = sampler(shingles, weights)
            pairs = np.stack([shingle, step.view(np.uint64)], 1).reshape(bands, rows * 2)
            out["bands"].append([combined([k, *p]) for k, p in enumerate(pairs)])
        return out

    return map_rows(texts, "id long, digest string, bands array<long>, weight double", sign)


_SAMPLERS: dict[int, Sampler] = {}


def _sampler(samples: int) -> Sampler:
    if samples not in _SAMPLERS:
        _SAMPLERS[samples] = Sampler(samples)
    return _SAMPLERS[samples]


def verified(pairs: DataFrame, texts: DataFrame, idf: Broadcast, least: float) -> DataFrame:
    """The pairs (a, b) of nodes whose similarity is ``least`` or more."""

    def check(batch: pa.RecordBatch) -> dict[str, list]:
        out: dict[str, list] = {"a": [], "b": [], "similarity": []}
        last, vector = None, None
        columns = [c.to_pylist() for c in batch.columns]
        for a, b, text_a, text_b in zip(*columns):
            if a != last:
                last, vector = a, weighted(text_a, idf.value)
            found = similarity(vector, weighted(text_b, idf.value))
            if found >= least:
                out["a"].append(a)
                out["b"].append(b)
                out["similarity"].append(found)
        return out

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
    return map_rows(both, "a long, b long, similarity double", check)


def near_duplicates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least: float = SIMILAR,
    bands: int = BANDS,
    rows: int = ROWS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(doc_id, class_id, class_size), one row per document.

    ``class_id`` is the same for documents that equal texts and links of similarity
    ``least`` or more connect.
    """
    classes, sizes = text_classes(documents, id_column, text_column, least, bands, rows, buckets)
    rows_out = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), digest(text_column, id_column).alias("digest")
    )
    return rows_out.join(classes.join(sizes, "root"), "digest").select("doc_id", "class_id", "class_size")


def digest(text_column: str, id_column: str) -> Column:
    """One value per distinct text; texts without a word are told apart by their ids."""
    text = F.col(text_column)
    alone = F.concat(F.lit("-"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    return F.when(text.rlike(r"[^\x20\x09-\x0D]"), F.md5(text)).otherwise(alone)


def _placed(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return documents.select(
        F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"), digest(text_column, id_column).alias("digest")
    )


def text_classes(
    documents: DataFrame, id_column: str, text_column: str, least: float, bands: int, rows: int, buckets: int
) -> tuple[DataFrame, DataFrame]:
    """(digest, root) of every distinct text, and (root, class_id, class_size) of every class."""
    spark = documents.sparkSession
    keep = Written(spark)
    counts, n = frequencies(documents.select(text_column), buckets)
    idf = spark.sparkContext.broadcast(inverse(counts, n))
    signed = signatures(_placed(documents, id_column, text_column), idf, bands, rows)
    equal = signed.groupBy("digest").agg(
        F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands"), F.first("weight").alias("weight")
    )
    # ids are drawn once and written, so every later read sees the same
    nodes = keep(equal.withColumn("node", F.monotonically_increasing_id()))

    members = nodes.select("node", "weight", F.explode("bands").alias("bucket"))
    hubs = members.groupBy("bucket").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = keep(members.join(hubs, "bucket"))
    wanted = members.select("node").distinct().join(nodes.select("node", "digest", "first_id"), "node")
    named = wanted.select("node", F.col("digest").alias("_digest"), F.col("first_id"))
    placed = _placed(documents, id_column, text_column)
    same = (placed["id"].eqNullSafe(F.col("first_id"))) & (placed["digest"] == F.col("_digest"))
    texts = keep(placed.join(named, same).groupBy("node").agg(F.any_value("text").alias("text")))

    joined = connected(members, texts, idf, least, keep)
    roots = nodes.select("node", "digest", "first_id", "n").join(joined, "node", "left")
    roots = keep(roots.withColumn("root", F.coalesce("root", "node")))
    keep.drop(members, texts)
    sizes = roots.groupBy("root").agg(F.min("first_id").alias("class_id"), F.sum("n").alias("class_size"))
    return roots.select("digest", "root"), sizes


def connected(members: DataFrame, texts: DataFrame, idf: Broadcast, least: float, keep: Written) -> DataFrame:
    """(node, root) of the members that similar pairs within buckets connect."""
    weights = members.select("node", "weight").distinct()

    def similar(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The tested pairs and those among them that are linked; a < b."""
        one, two = (weights.select(F.col("node").alias(x), F.col("weight").alias(f"w{x}")) for x in "ab")
        able = F.least("wa", "wb") >= least * F.greatest("wa", "wb") - 1e-6
        tested = keep(pairs.distinct().join(one, "a").join(two, "b").filter(able).select("a", "b"))
        return tested, keep(verified(tested, texts, idf, least).select("a", "b"))

    star = members.filter("node != centre").select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
    tested, links = similar(star)
    used = members.select("bucket", F.col("centre").alias("node")).distinct()
    joined = components(links)
    for turn in range(HUBS + 1):
        now = members.join(joined, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
        split = now.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
        left = keep(now.join(split.select("bucket"), "bucket"))
        if turn < HUBS:
            ends = links.select(F.explode(F.array("a", "b")).alias("node"))
            degree = ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
            fresh_hubs = left.join(used, ["bucket", "node"], "left_anti").join(degree, "node", "left")
            hub = keep(
                fresh_hubs.groupBy("bucket").agg(F.max(F.struct(F.coalesce("degree", F.lit(0)), "node", "root")).alias("hub")).select(
                    "bucket", F.col("hub.node").alias("y"), F.col("hub.root").alias("ry")
                )
            )
            used = used.unionByName(hub.select("bucket", F.col("y").alias("node")))
            pairs = left.join(hub, "bucket").withColumnsRenamed({"node": "x", "root": "rx"})
        else:
            other = left.select("bucket", F.col("node").alias("y"), F.col("root").alias("ry"))
            pairs = left.select("bucket", F.col("node").alias("x"), F.col("root").alias("rx")).join(other, "bucket")
        fresh = pairs.filter("rx != ry").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        more, found = similar(fresh.join(tested, ["a", "b"], "left_anti"))
        tested, links = tested.unionByName(more), links.unionByName(found)
        # the components so far stand for the links that made them
        known = joined.filter("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))
        joined = components(known.unionByName(found))
    return joined


def one_of_each(documents: DataFrame, **settings: float) -> DataFrame:
    """The documents with one of each class: that with the smallest id (then text), all columns kept."""
    options = {"least": SIMILAR, "bands": BANDS, "rows": ROWS, "buckets": BUCKETS} | settings
    keep = Written(documents.sparkSession)
    classes, _ = text_classes(documents, "doc_id", "text", **options)
    slim = documents.select(F.col("doc_id").cast("long").alias("id"), digest("text", "doc_id").alias("digest"))
    best = slim.join(classes, "digest").groupBy("root").agg(F.min(F.struct("id", "digest")).alias("best"))
    chosen = keep(best.select(F.col("best.id").alias("kept_id"), F.col("best.digest").alias("kept_digest")))
    # a row travels as one struct: no column of the table can clash
    hashed = [F.col(f"`{f.name}`") for f in documents.schema if "map<" not in f.dataType.simpleString()]
    rows = documents.select(
        F.struct(*[F.col(f"`{n}`") for n in documents.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("id"), digest("text", "doc_id").alias("digest"), F.xxhash64(*hashed).alias("tie"),
    )
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("digest") == F.col("kept_digest"))
    # of rows with the same id and text the one with the smallest hash of all its columns stays
    return rows.join(chosen, same).groupBy("kept_id", "kept_digest").agg(F.min_by("row", "tie").alias("row")).select("row.*")
