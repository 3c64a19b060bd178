"""Line deduplication by an exact set-similarity join.

A line is the set of its words. Tokens are ordered by rarity (occurrences over all lines,
counted in ``buckets`` counters by hash; ties by the hash itself): any one order of all
tokens gives right results, a good one gives short lists. Two sets with Jaccard similarity
``similar`` or more must share a token within their prefixes, the first
``n - ceil(similar * n) + 1`` tokens of the longer one and the first
``n - ceil(2 similar / (1 + similar) * n) + 1`` of the shorter one. Lines meet on such
tokens, and a pair goes on only if its lengths, the places of the shared token and a
parity bitmap of both sets still allow the similarity. What is left is verified on the
sets themselves. Lines of ``SHORT`` words at most, for which similarity means that one set
holds the other, meet on their subsets instead, as their prefixes would be common words.

A line is removed if a line before it, in order of (document id, line number), is similar
to it. Lines with equal sets are one class and join once. Lines without a word are never
removed. Null and empty texts have no lines; rows with equal ids are told apart by a hash
of their text, and among equal rows by nothing, so their lines are matches of one another
only within the text.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from cohortloom.llm.bloom import Bloom, hit
from cohortloom.llm.common import Written, arrow_types
from cohortloom.llm.tokens import combined, hashed, scramble

SIMILAR = 0.8
BUCKETS = 1 << 20
SHORT = 8
# Of the prefix, the tokens by which a line looks for a first line before the join.
KEYS = 3
# Tokens handled at once.
BLOCK = 1 << 17


def at_least(share: float, n):
    """ceil(share * n) without the errors of binary fractions."""
    return np.ceil(np.round(share * np.asarray(n), 9)).astype(np.int64)


class Lines:
    """The token sets of many lines, flat: line ``i`` has ``tokens[start[i]:start[i + 1]]``, sorted."""

    def __init__(self, rows: list[tuple[int, int, list[bytes]]]) -> None:
        """Rows are (row of the batch, line number, words)."""
        self.row = np.array([r[0] for r in rows], np.int64)
        self.number = np.array([r[1] for r in rows], np.int64)
        flat = hashed(list(itertools.chain.from_iterable(r[2] for r in rows)))
        line = np.repeat(np.arange(len(rows)), [len(r[2]) for r in rows])
        order = np.lexsort((flat, line))
        flat, line = flat[order], line[order]
        new = np.append(True, (flat[1:] != flat[:-1]) | (line[1:] != line[:-1]))
        self.tokens, self.line = flat[new], line[new]
        self.size = np.bincount(self.line, minlength=len(rows))
        self.start = np.append(0, np.cumsum(self.size))

    def classes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit numbers that stand for each set."""
        first = self.start[:-1]
        one = np.add.reduceat(scramble(self.tokens ^ np.uint64(0xA5A5A5A5)), first)
        two = np.add.reduceat(scramble(self.tokens ^ np.uint64(0x3C3C3C3C3C)), first)
        return one.view(np.int64), two.view(np.int64)

    def bitmaps(self) -> np.ndarray:
        """Parity of the tokens in each of 64 places: differing bits never outnumber differing tokens."""
        place = (scramble(self.tokens + np.uint64(1)) & np.uint64(63)).astype(np.int64)
        odd = np.bincount(self.line * 64 + place, minlength=64 * len(self.size)).astype(np.uint8) & 1
        return np.packbits(odd.reshape(-1, 64), axis=1).view(np.int64)[:, 0]

    def prefixes(self, counts: np.ndarray, similar: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line, token, place) of the prefix tokens that may occur elsewhere, rarest first."""
        known = counts[(self.tokens % np.uint64(len(counts))).astype(np.int64)]
        order = np.lexsort((self.tokens, known, self.line))
        place = np.arange(len(order)) - self.start[self.line]
        length = self.size - at_least(similar, self.size) + 1
        kept = (place < length[self.line]) & (known[order] > 1)
        return self.line[kept], self.tokens[order][kept], place[kept]


def line_blocks(batch: pa.RecordBatch) -> Iterator[Lines]:
    """The lines with a word of a batch whose second column is the text."""
    rows, held = [], 0
    for at, text in enumerate(batch.column(1).to_pylist()):
        for number, line in enumerate(text.split("\n") if text else ()):
            found = line.encode("utf-8", "surrogatepass").split()
            if found:
                rows.append((at, number, found))
                held += len(found)
        if held >= BLOCK:
            yield Lines(rows)
            rows, held = [], 0
    if rows:
        yield Lines(rows)


def subsets(tokens: np.ndarray, similar: float) -> tuple[int, list[int]]:
    """Hash of a short set, and of its subsets that are as similar as asked for."""
    n = len(tokens)
    own = combined(tokens.tolist())
    parts = []
    for m in range(int(at_least(similar, n)), min(n, SHORT + 1)):
        parts += [combined(c) for c in itertools.combinations(tokens.tolist(), m)]
    return own, parts


def longest_short(similar: float) -> int:
    """Size of the largest set that can be similar to one of ``SHORT`` tokens."""
    return int(math.floor(round(SHORT / similar, 9)))


def token_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """Lines per token bucket; at most ``buckets`` rows reach the driver."""
    schema = "bucket long, n long"
    kinds = arrow_types(texts.sparkSession, schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for lines in line_blocks(batch):
                counts += np.bincount((lines.tokens % np.uint64(buckets)).astype(np.int64), minlength=buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, kinds["bucket"]), pa.array(counts[at], kinds["n"])], names=list(kinds))

    found = texts.mapInArrow(count, schema).groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets, np.int64)
    counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return counts


LINES = (
    "doc long, tie long, number int, one long, two long, size int, bitmap long,"
    " tokens array<long>, places array<int>, own long, parts array<long>"
)


def line_rows(texts: DataFrame, counts: Broadcast, similar: float) -> DataFrame:
    """One row per line of (doc, text, tie): class, size, bitmap, prefix and short-set keys."""
    kinds = arrow_types(texts.sparkSession, LINES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0), batch.column(2)
            for lines in line_blocks(batch):
                one, two = lines.classes()
                line, token, place = lines.prefixes(counts.value, similar)
                cuts = pa.array(np.append(0, np.cumsum(np.bincount(line, minlength=len(one)))), pa.int32())
                keys: list[tuple] = [(None, None)] * len(one)
                for i in np.flatnonzero(lines.size <= longest_short(similar)).tolist():
                    keys[i] = subsets(lines.tokens[lines.start[i] : lines.start[i + 1]], similar)
                at = pa.array(lines.row)
                yield pa.RecordBatch.from_arrays(
                    [
                        docs[0].take(at), docs[1].take(at), pa.array(lines.number, pa.int32()), pa.array(one), pa.array(two),
                        pa.array(lines.size, pa.int32()), pa.array(lines.bitmaps()),
                        pa.ListArray.from_arrays(cuts, pa.array(token.view(np.int64))).cast(kinds["tokens"]),
                        pa.ListArray.from_arrays(cuts, pa.array(place, pa.int32())).cast(kinds["places"]),
                        pa.array([k[0] for k in keys], kinds["own"]), pa.array([k[1] for k in keys], kinds["parts"]),
                    ],
                    names=list(kinds),
                )

    return texts.mapInArrow(run, LINES)


def class_rows(texts: DataFrame) -> DataFrame:
    """(doc, tie, number, one, two) of every line with a word."""
    schema = "doc long, tie long, number int, one long, two long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lines in line_blocks(batch):
                one, two = lines.classes()
                at = pa.array(lines.row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(2).take(at), pa.array(lines.number, pa.int32()), pa.array(one), pa.array(two)],
                    names=["doc", "tie", "number", "one", "two"],
                )

    return texts.mapInArrow(run, schema)


def wanted_sets(texts: DataFrame, wanted: DataFrame, bits: int) -> DataFrame:
    """(node, tokens) of the classes in ``wanted`` (node, one, two).

    A Bloom filter of the classes keeps the other lines from the shuffle.
    """
    schema = "one long, two long, tokens array<long>"
    kinds = arrow_types(texts.sparkSession, schema)
    bloom = Bloom(wanted.select("one"), "one", bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = bloom.bits()
        for batch in batches:
            for lines in line_blocks(batch):
                one, two = lines.classes()
                at = np.flatnonzero(hit(filled, one.view(np.uint64)))
                tokens = [lines.tokens[lines.start[i] : lines.start[i + 1]].view(np.int64) for i in at.tolist()]
                columns = pa.array(one[at]), pa.array(two[at]), pa.array(tokens, kinds["tokens"])
                yield pa.RecordBatch.from_arrays(list(columns), names=list(kinds))

    found = texts.mapInArrow(run, schema).join(wanted, ["one", "two"])
    return found.groupBy("node").agg(F.any_value("tokens").alias("tokens"))


def _need(a: str, b: str, similar: float):
    """Shared tokens that sets of two sizes need."""
    return F.ceil(F.round(F.lit(similar / (1 + similar)) * (F.col(a) + F.col(b)), 9))


def possible(pairs: DataFrame, similar: float) -> DataFrame:
    """Pairs (x, y with size_, bitmap_) that length filter and bitmaps leave."""
    longer, shorter = F.greatest("size_x", "size_y"), F.least("size_x", "size_y")
    differ = F.bit_count(F.col("bitmap_x").bitwiseXOR(F.col("bitmap_y")))
    return pairs.filter(
        (shorter >= F.round(F.lit(similar) * longer, 9)) & (differ <= F.col("size_x") + F.col("size_y") - 2 * _need("size_x", "size_y", similar))
    )


def similar_lines(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    similar: float = SIMILAR,
    buckets: int = BUCKETS,
) -> tuple[DataFrame, DataFrame]:
    """Classes of lines (node, one, two, n, doc, tie, number) and, of those that match an earlier class, (node, earlier).

    Nodes are numbered in the order of the classes' first lines, which doc, tie and number name.
    """
    spark = documents.sparkSession
    keep = Written(spark)
    texts = line_texts(documents, id_column, text_column)
    counts = spark.sparkContext.broadcast(token_counts(texts, buckets))
    first = F.min(F.struct("doc", "tie", "number")).alias("first")
    rest = [F.any_value(c).alias(c) for c in ("size", "bitmap", "tokens", "places", "own", "parts")]
    grouped = line_rows(texts, counts, similar).groupBy("one", "two").agg(first, F.count(F.lit(1)).alias("n"), *rest)
    ordered = grouped.repartitionByRange("first").sortWithinPartitions("first")
    classes = keep(ordered.withColumn("node", F.monotonically_increasing_id()).select("*", "first.*").drop("first"))

    def sided(rows: DataFrame, side: str, *names: str) -> DataFrame:
        return rows.select(*[F.col(n).alias(f"{n}_{side}") for n in ("node", "size", "bitmap")], *names)

    def verified(pairs: DataFrame) -> DataFrame:
        """(x, y) of similar classes, x before y."""
        pairs = keep(pairs.select(F.least("node_x", "node_y").alias("x"), F.greatest("node_x", "node_y").alias("y")).distinct())
        ends = pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct()
        wanted = keep(ends.join(classes.select("node", "one", "two"), "node"))
        bits = 1 << min(28, max(20, (32 * wanted.count()).bit_length()))
        sets = keep(wanted_sets(texts, wanted, bits))
        both = pairs.join(sets.select(F.col("node").alias("x"), F.col("tokens").alias("tx")), "x").join(
            sets.select(F.col("node").alias("y"), F.col("tokens").alias("ty")), "y"
        )
        shared = F.size(F.array_intersect("tx", "ty"))
        either = F.size("tx") + F.size("ty") - shared
        return keep(both.filter(shared >= F.round(F.lit(similar) * either, 9)).select("x", "y"))

    # a first look: each line against the first and the most frequent line that have one of its rarest
    # shared tokens; of a line with many variants that is most often the line itself
    long = classes.filter(F.col("size") > SHORT)
    keyed = long.select("node", "size", "bitmap", "n", F.explode(F.slice("tokens", 1, KEYS)).alias("key"))
    line = ("node", "size", "bitmap")
    heads = keyed.groupBy("key").agg(
        F.min(F.struct(*line)).alias("first"), F.max(F.struct("n", -F.col("node"), *line)).alias("most"), F.count(F.lit(1)).alias("f")
    ).filter("f > 1")
    both_heads = heads.select("key", "first.*").unionByName(heads.select("key", *[F.col(f"most.{c}").alias(c) for c in line]))
    looks = sided(keyed, "y", "key").join(sided(both_heads.distinct(), "x", "key"), "key")
    # short sets: one holds the other
    whole = sided(classes.filter("own is not null"), "x", F.col("own").alias("key"))
    part = sided(classes.filter("parts is not null"), "y", F.explode("parts").alias("key"))
    begun = possible(looks, similar).filter("node_x != node_y").select("node_x", "node_y").unionByName(
        whole.join(part, "key").select("node_x", "node_y")
    )
    early = verified(begun)
    done = early.select(F.col("y").alias("node")).distinct()

    # the join by prefixes, for pairs whose later line has no match yet
    marked = long.join(done.withColumn("done", F.lit(True)), "node", "left")
    rows = marked.select(
        "node", "size", "bitmap", F.col("done").isNotNull().alias("done"), F.explode(F.arrays_zip("tokens", "places")).alias("at")
    ).select(
        F.col("at.tokens").alias("token"), "node", "bitmap",
        # size, place and mark in one number: the rows of this shuffle are many
        (F.shiftleft(F.col("size").cast("long"), 32) + F.col("at.places") * 2 + F.col("done").cast("int")).alias("packed"),
    )
    def size(side: str):
        return F.shiftright(F.col(f"packed{side}"), 32)

    def place(side: str):
        return F.shiftright(F.col(f"packed{side}").bitwiseAND(0xFFFFFFFF), 1)

    def marked_done(side: str):
        return F.col(f"packed{side}").bitwiseAND(1) == 1

    short_prefix = size("") - F.ceil(F.round(F.lit(2 * similar / (1 + similar)) * size(""), 9)) + 1
    probe, index = (
        side.select("token", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "bitmap", "packed")])
        for side, x in ((rows, "y"), (rows.filter(place("") < short_prefix), "x"))
    )
    left = F.least(size("_x") - place("_x"), size("_y") - place("_y"))
    differ = F.bit_count(F.col("bitmap_x").bitwiseXOR(F.col("bitmap_y")))
    need = F.ceil(F.round(F.lit(similar / (1 + similar)) * (size("_x") + size("_y")), 9))
    # x is the shorter set (the earlier one of equal sizes); either may be the later line
    on = (
        (probe["token"] == index["token"])
        & ((size("_x") < size("_y")) | (size("_x") == size("_y")) & (F.col("node_x") < F.col("node_y")))
        & (size("_x") >= F.round(F.lit(similar) * size("_y"), 9))
        & (left >= need) & (differ <= size("_x") + size("_y") - 2 * need)
        & ~F.when(F.col("node_x") < F.col("node_y"), marked_done("_y")).otherwise(marked_done("_x"))
    )
    late = verified(index.join(probe, on).select("node_x", "node_y"))
    matched = early.unionByName(late).groupBy(F.col("y").alias("node")).agg(F.min("x").alias("earlier"), F.count(F.lit(1)).alias("n_links"))
    return classes.select("node", "one", "two", "n", "doc", "tie", "number"), matched


def line_texts(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.col(text_column)
    return documents.select(F.col(id_column).cast("long").alias("doc"), text.alias("text"), F.xxhash64(text).alias("tie"))


def removed_lines(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", similar: float = SIMILAR, buckets: int = BUCKETS
) -> DataFrame:
    """(doc, tie, number, earlier_doc, earlier_number): each line to remove and the first line it matches."""
    keep = Written(documents.sparkSession)
    classes, matched = similar_lines(documents, id_column, text_column, similar, buckets)
    named = classes.join(matched, "node", "left").filter("n > 1 or earlier is not null")
    heads = classes.select(F.col("node").alias("earlier"), F.col("doc").alias("head_doc"), F.col("number").alias("head_number"))
    flagged = keep(
        named.select("one", "two", F.col("doc").alias("first_doc"), F.col("tie").alias("first_tie"), F.col("number").alias("first_number"), "earlier")
        .join(heads, "earlier", "left")
    )
    lines = class_rows(line_texts(documents, id_column, text_column)).join(flagged, ["one", "two"])
    itself = F.col("doc").eqNullSafe(F.col("first_doc")) & (F.col("tie") == F.col("first_tie")) & (F.col("number") == F.col("first_number"))
    known = F.col("earlier").isNotNull()
    return lines.filter(~itself | known).select(
        "doc", "tie", "number",
        F.when(known, F.col("head_doc")).otherwise(F.col("first_doc")).alias("earlier_doc"),
        F.when(known, F.col("head_number")).otherwise(F.col("first_number")).alias("earlier_number"),
    )


def dedup_lines(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", similar: float = SIMILAR, buckets: int = BUCKETS
) -> DataFrame:
    """(doc_id, text, n_lines, removed): each text without its removed lines, and their numbers from 0."""
    removed = removed_lines(documents, id_column, text_column, similar, buckets)
    # rows equal in id and text share their removed lines
    found = removed.distinct().groupBy(F.col("doc").alias("_doc"), F.col("tie").alias("_tie")).agg(F.sort_array(F.collect_set("number")).alias("removed"))
    texts = line_texts(documents, id_column, text_column)
    joined = texts.join(found, texts["doc"].eqNullSafe(F.col("_doc")) & (texts["tie"] == F.col("_tie")), "left")
    lines = F.split("text", "\n", -1)
    none = F.array().cast("array<int>")
    kept = F.filter(lines, lambda line, at: ~F.array_contains(F.col("removed"), at))
    return joined.withColumn("removed", F.coalesce("removed", none)).select(
        F.col("doc").alias("doc_id"),
        F.when(F.size("removed") == 0, F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        "removed",
    )
