"""Phrases of two to four words that stick together, from suffix subtrees built apart.

A suffix is what follows a word inside its piece of text, cut after four words. The tree of
all suffixes is never whole anywhere (vertical partitioning):

1. Words are counted. A phrase of 30 occurrences has frequent words and frequent pairs only, so
   a suffix ends before the first word, or pair, that a Bloom filter of the frequent ones
   does not hold. The filters have a fixed size; what they let through by chance costs time,
   not correctness.
2. Suffixes are counted where they are read and written as a table of leaves. Prefixes with
   more leaves than the memory budget of a group are made one word longer, level by level;
   there are at most leaves / budget of them per level, and the budget is at least 1/4096
   of the leaves, so these trunks are a bounded table. All other prefixes are dealt
   into small buckets, and buckets are packed into groups up to the budget.
3. A group's leaves are sorted by Spark and read as a stream: the nodes open at any moment
   are one path of four words. The count of a node is the sum of its leaves; the subtrees
   of a group end at their prefix, above it are the trunks.
4. Candidates, their parts and their containing phrases are lookups among the nodes. Nodes of more
   than 1/4096 of all words are broadcast (at most 4 * 4096), the others are joined.

Words are 64-bit hashes while they move. No two words of a language may share a
hash: the word counts would show it, and then the next seed is taken.

Counts are exact: products that may pass 64 bits are decimals.

Odd input: null text is empty, null lang is `und`; empty texts give no words; a long text or
piece is one row that is read in order; repeated rows count each time; ties go by phrase;
other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortloom.llm.bloom import Bloom, hit
from cohortloom.llm.common import Written, arrow_types
from cohortloom.llm.tokens import ODD, scramble

DEPTH = 4
LEAST = 30
# A phrase goes if a longer candidate around it has 80 % of its occurrences.
INSIDE = 80
TOP = 2000
SCALE = 2_000_000
# Leaves of one group of subtrees, and how many groups there are at most.
GROUP_LEAVES = 1 << 19
MOST_GROUPS = 1 << 12
# Tokens that are turned into arrays at once, and leaves counted before they leave a task.
SLICE_BYTES = 1 << 22
FLUSH = 1 << 20
# Words of the longest runs that are counted beforehand, so that suffixes end before rare ones.
PRUNED = 2
# Words a task counts before it passes them on, and hashes it remembers.
MEMORY = 1 << 17

WORDS = [f"w{k}" for k in range(1, DEPTH + 1)]
LEAVES = ", ".join(["lang string", *[f"{w} long" for w in WORDS], "n long"])
# 0xFF is in no UTF-8 text: it stands for the end of a piece.
END = b"\xff"
_FOLD = bytes.maketrans(
    bytes(range(65, 91)) + b".,;:!?\x0a\x0b\x0c\x0d", bytes(range(97, 123)) + END * 10
)


def tokens(text: str | None) -> list[bytes]:
    """Lower-case words of a text, with END between and behind its pieces."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass").translate(_FOLD)
    return (raw + END).replace(END, b" \xff ").split()


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """The tokens of many texts of one language, some megabytes at a time."""
    found: dict[str, list[bytes]] = {}
    size = 0
    for start in range(0, batch.num_rows, 64):
        part = batch.slice(start, 64)
        for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            found.setdefault(lang, []).extend(tokens(text))
            size += len(text)
            if size > SLICE_BYTES:
                yield from found.items()
                found, size = {}, 0
    yield from found.items()


class WordHashes(dict):
    """Word to its hash under a seed; END is 0 and no word is."""

    def __init__(self, seed: int) -> None:
        super().__init__({END: 0})
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
            self[END] = 0
        value = self[word] = xxhash.xxh3_64_intdigest(word, self.seed) or 1
        return value

    def array(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, word, hash, n), counted in part: rows repeat."""
    schema = "lang string, word binary, hash long, n long"
    kinds = arrow_types(docs.sparkSession, schema)

    def flush(counted: dict[str, Counter], hashes: WordHashes) -> Iterator[pa.RecordBatch]:
        for lang, words in counted.items():
            words.pop(END, None)
            if words:
                listed = list(words)
                columns = [[lang] * len(words), listed, hashes.array(listed).view(np.int64), list(words.values())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: dict[str, Counter] = {}
        hashes = WordHashes(seed)
        for batch in batches:
            for lang, found in _by_lang(batch):
                counted.setdefault(lang, Counter()).update(found)
                if sum(map(len, counted.values())) > MEMORY:
                    yield from flush(counted, hashes)
                    counted = {}
        yield from flush(counted, hashes)

    return _texts(docs).mapInArrow(run, schema)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").filter("text IS NOT NULL AND text <> ''")


def lang_seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass")))


def gram_keys(lang: str, words: list[np.ndarray]) -> np.ndarray:
    """One hash of neighbours, for the filters only."""
    with np.errstate(over="ignore"):
        key = words[0]
        for word in words[1:]:
            key = key * ODD + word
        return scramble(key ^ lang_seed(lang))


def counted_rows(rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows (columns are words) added up; equal ones may stay apart, unequal ones never meet."""
    if not len(n):
        return rows, n
    with np.errstate(over="ignore"):
        key = rows[0].copy()
        for column in rows[1:]:
            key = scramble(key * ODD + column)
    order = np.argsort(key)
    rows = rows[:, order]
    starts = np.flatnonzero(np.concatenate([[True], (rows[:, 1:] != rows[:, :-1]).any(axis=0)]))
    return rows[:, starts], np.add.reduceat(n[order], starts)


def _linked(lang: str, words: np.ndarray, bits: list[np.ndarray]) -> list[np.ndarray]:
    """For each size from 2 up: where a run of that size starts that may be frequent."""
    size = len(words)
    linked = [np.concatenate([words != 0, np.zeros(DEPTH, bool)])]
    for k, known in enumerate(bits, start=2):
        # both runs that are one shorter are frequent
        at = np.flatnonzero(linked[-1][:size] & linked[-1][1 : size + 1])
        mark = np.zeros(size + DEPTH, bool)
        mark[at] = hit(known, gram_keys(lang, [words[at + j] for j in range(k)]))
        linked.append(mark)
    return linked


def _sums(docs: DataFrame, seed: int, schema: str, rows_of, frequent: Bloom, filters: list[Bloom]) -> DataFrame:
    """Rows that ``rows_of(lang, words, filters)`` finds, counted per language within a task.

    Words that are not frequent are 0 there, like the ends of pieces: no phrase crosses them.
    """
    kinds = arrow_types(docs.sparkSession, schema)
    shared = [b.sent for b in (frequent, *filters)]
    with_lang = "lang" in kinds

    def batch_of(lang: str, parts: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        rows, n = counted_rows(np.concatenate(parts, axis=1), np.concatenate(counts))
        columns = [pa.array([lang] * len(n), pa.string())] if with_lang else []
        columns += [*[pa.array(c.view(np.int64)) for c in rows], pa.array(n)]
        return pa.RecordBatch.from_arrays(columns, names=list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, *bits = [np.frombuffer(s.value, np.uint8) for s in shared]
        hashes = WordHashes(seed)
        parts: dict[str, list[np.ndarray]] = {}
        counts: dict[str, list[np.ndarray]] = {}
        held = 0
        for batch in batches:
            for lang, found in _by_lang(batch):
                words = hashes.array(found)
                words[(words != 0) & ~hit(known, scramble(words ^ lang_seed(lang)))] = 0
                rows, n = counted_rows(*rows_of(lang, words, bits))
                if len(n):
                    parts.setdefault(lang, []).append(rows)
                    counts.setdefault(lang, []).append(n)
                    held += len(n)
                if held > FLUSH:
                    for done in list(parts):
                        yield batch_of(done, parts.pop(done), counts.pop(done))
                    held = 0
        for lang in parts:
            yield batch_of(lang, parts[lang], counts[lang])

    return _texts(docs).mapInArrow(run, schema)


def gram_counts(docs: DataFrame, seed: int, frequent: Bloom, shorter: list[Bloom]) -> DataFrame:
    """(gram, n): runs of one word more than ``shorter`` knows, counted by a hash in part."""

    def rows_of(lang: str, words: np.ndarray, bits: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        last, size = _linked(lang, words, bits)[-1], len(words)
        at = np.flatnonzero(last[:size] & last[1 : size + 1])
        keys = gram_keys(lang, [words[at + j] for j in range(len(bits) + 2)])
        return keys[None, :], np.ones(len(keys), np.int64)

    return _sums(docs, seed, "gram long, n long", rows_of, frequent, shorter)


def leaves(docs: DataFrame, seed: int, frequent: Bloom, filters: list[Bloom]) -> DataFrame:
    """(lang, w1..w4, n): suffixes cut after four words or before a rare run; 0 for no word."""

    def rows_of(lang: str, words: np.ndarray, bits: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        linked = _linked(lang, words, bits)
        starts = np.flatnonzero(words)
        padded = np.concatenate([words, np.zeros(DEPTH, np.uint64)])
        rows, going = [padded[starts]], np.ones(len(starts), bool)
        for k in range(1, DEPTH):
            longest = min(k + 1, len(linked))  # words of the runs that are known
            going = going & linked[longest - 1][starts + k + 1 - longest]
            rows.append(np.where(going, padded[starts + k], 0).astype(np.uint64))
        return np.array(rows), np.ones(len(starts), np.int64)

    return _sums(docs, seed, LEAVES, rows_of, frequent, filters)


def _words_of(depth: int) -> list[str]:
    return ["lang", *WORDS[:depth]]


def trunks(leaf_rows: DataFrame, budget: int) -> list[DataFrame]:
    """Prefixes of 1, 2 and 3 words with more leaves than the budget, with their counts."""
    found, rows = [], leaf_rows
    for depth in range(1, DEPTH):
        over = (
            rows.groupBy(*_words_of(depth)).agg(F.count(F.lit(1)).alias("_leaves"), F.sum("n").alias("f"))
            .filter((F.col("_leaves") > budget) & (F.col(WORDS[depth - 1]) != 0)).drop("_leaves")
        )
        listed = over.collect()  # leaves / budget rows at most
        over = leaf_rows.sparkSession.createDataFrame(listed, over.schema)
        found.append(over)
        if not listed:
            break
        rows = rows.join(F.broadcast(over.drop("f")), _words_of(depth))
    return found


def grouped(leaf_rows: DataFrame, over: list[DataFrame], budget: int, n_leaves: int) -> tuple[DataFrame, int]:
    """Leaves with the length of their prefix and the number of their group.

    A leaf that ends inside a trunk belongs to no group: the trunk has counted it.
    """
    rows, inside = leaf_rows, F.lit(1)
    for depth, table in enumerate(over, start=1):
        mark = f"_in{depth}"
        rows = rows.join(F.broadcast(table.drop("f").withColumn(mark, F.lit(1))), _words_of(depth), "left")
        inside = inside + F.coalesce(mark, F.lit(0))
    placed = rows.select(*leaf_rows.columns, inside.alias("prefix"))
    next_word = F.element_at(F.array(*WORDS), F.col("prefix"))
    key = F.xxhash64("lang", *[F.when(F.col("prefix") >= k, F.col(w)) for k, w in enumerate(WORDS, start=1)])
    buckets = 4 * max(1, min(MOST_GROUPS, -(-n_leaves // budget)))
    placed = placed.filter(next_word != 0).withColumn("bucket", F.pmod(key, F.lit(buckets)).cast("int"))
    sizes = {r["bucket"]: r["n"] for r in placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    group_of, group, filled = [0] * buckets, 0, 0
    for bucket in range(buckets):
        size = sizes.get(bucket, 0)
        if filled and filled + size > budget:
            group, filled = group + 1, 0
        group_of[bucket] = group
        filled += size
    # at most 4 * MOST_GROUPS numbers
    packed = F.element_at(F.lit(np.array(group_of, np.int32)), F.col("bucket") + 1)
    return placed.withColumn("group", packed).drop("bucket"), group + 1


class OpenPath:
    """Nodes of sorted leaves; only the nodes of the last leaf are still open."""

    def __init__(self) -> None:
        self.rows: np.ndarray | None = None  # one leaf: group, prefix, four words
        self.open = np.zeros(DEPTH, np.int64)

    def add(self, group: np.ndarray, rows: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(depth, rows, counts) of the nodes that ``rows`` close, the last path staying open."""
        if self.rows is not None:
            group = np.concatenate([self.rows[0][:1], group])
            rows = np.concatenate([self.rows[1][:, :1], rows], axis=1)
            n = np.concatenate([[0], n])
        changed = np.concatenate([[True], group[1:] != group[:-1]])
        for depth in range(1, DEPTH + 1):
            changed[1:] |= rows[depth][1:] != rows[depth][:-1]
            starts = np.flatnonzero(changed)
            sums = np.add.reduceat(n, starts)
            if self.rows is not None:
                sums[0] += self.open[depth - 1]
            self.open[depth - 1] = sums[-1]
            yield depth, rows[:, starts[:-1]], sums[:-1]
        self.rows = (group[-1:], rows[:, -1:])

    def close(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        if self.rows is not None:
            for depth in range(1, DEPTH + 1):
                yield depth, self.rows[1], self.open[depth - 1 : depth]


def subtrees(placed: DataFrame, groups: int, least: int) -> DataFrame:
    """(lang, w1..w4, f): nodes at or below their group's prefix with ``least`` occurrences."""
    schema = ", ".join(["lang string", *[f"{w} long" for w in WORDS], "f long"])
    kinds = arrow_types(placed.sparkSession, schema)

    def nodes(path: OpenPath, found) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for depth, rows, counts in found:
            here = (rows[depth] != 0) & (rows[0] <= depth) & (counts >= least)
            if here.any():
                words = rows[1:, here].copy()
                words[depth:] = 0
                yield words, counts[here]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, path = None, OpenPath()

        def out(found) -> Iterator[pa.RecordBatch]:
            for words, counts in nodes(path, found):
                columns = [pa.array([lang] * len(counts), pa.string()), *[pa.array(w) for w in words], pa.array(counts)]
                yield pa.RecordBatch.from_arrays(columns, names=list(kinds))

        for batch in batches:
            langs = batch.column(1).dictionary_encode()
            codes = langs.indices.to_numpy()
            values = [batch.column(k).to_numpy(zero_copy_only=False) for k in (0, *range(2, 8))]
            cuts = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), len(codes)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                name = langs.dictionary[int(codes[a])].as_py()
                if name != lang:
                    yield from out(path.close())
                    lang, path = name, OpenPath()
                rows = np.array([v[a:b] for v in values[1:6]], np.int64)
                yield from out(path.add(values[0][a:b], rows, values[6][a:b]))
        yield from out(path.close())

    dealt = placed.repartition(groups, "group").sortWithinPartitions("group", "lang", *WORDS)
    return dealt.select("group", "lang", "prefix", *WORDS, "n").mapInArrow(run, schema)


def phrase_counts(docs: DataFrame, keep: Written, least: int = LEAST, group_leaves: int = GROUP_LEAVES) -> tuple[DataFrame, DataFrame]:
    """Nodes (lang, w1..w4, f) with ``least`` occurrences, and words (lang, hash, word, n) likewise."""
    seed = 0
    while True:
        words = keep(word_counts(docs, seed).groupBy("lang", "word", "hash").agg(F.sum("n").alias("n")))
        if words.groupBy("lang", "hash").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").limit(1).count() == 0:
            break
        keep.drop(words)
        seed += 1
    word_filter = Bloom(_word_keys(words.filter(F.col("n") >= least)), "key")
    filters: list[Bloom] = []
    for _ in range(2, PRUNED + 1):
        grams = gram_counts(docs, seed, word_filter, filters).groupBy("gram").agg(F.sum("n").alias("n"))
        filters.append(Bloom(grams.filter(F.col("n") >= least), "gram"))
    leaf_rows = keep(leaves(docs, seed, word_filter, filters))
    n_leaves = leaf_rows.count()
    budget = max(group_leaves, -(-n_leaves // MOST_GROUPS))
    over = trunks(leaf_rows, budget)
    placed, groups = grouped(leaf_rows, over, budget, n_leaves)
    found = subtrees(placed, groups, least)
    for depth, table in enumerate(over, start=1):
        rest = [F.lit(0).cast("long").alias(w) for w in WORDS[depth:]]
        found = found.unionByName(table.filter(F.col("f") >= least).select(*_words_of(depth), *rest, "f"))
    nodes = keep(found)
    keep.drop(leaf_rows)
    return nodes, words


def _word_keys(words: DataFrame) -> DataFrame:
    kinds = arrow_types(words.sparkSession, "key long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds = {x: lang_seed(x) for x in batch.column(0).unique().to_pylist()}
            langs = np.array([seeds[x] for x in batch.column(0).to_pylist()], np.uint64)
            hashes = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(scramble(hashes ^ langs).view(np.int64), kinds["key"])], names=["key"])

    return words.select("lang", "hash").mapInArrow(run, "key long")


def _looked_up(rows: DataFrame, table: DataFrame, keys: list[str], value: str, hot: Column) -> DataFrame:
    """Left join on unique keys in which the few hot ones, bounded by ``hot``, are broadcast."""
    few = table.filter(hot).select(*keys, F.col(value).alias("_hot"))
    rest = table.filter(~hot).select(*keys, F.col(value).alias("_rest"))
    met = rows.join(F.broadcast(few), keys, "left")
    # rows of a hot key have their value and would only crowd one task
    found = met.filter("_hot IS NOT NULL").withColumn(value, F.col("_hot")).drop("_hot")
    other = met.filter("_hot IS NULL").drop("_hot").join(rest, keys, "left").withColumn(value, F.col("_rest")).drop("_rest")
    return found.unionByName(other)


def _part(words: list[Column], start: int, stop: int) -> list[Column]:
    """Words start..stop moved to the front, 0 behind them."""
    zero = F.lit(0).cast("long")
    return [words[start + k] if start + k < stop else zero for k in range(DEPTH)]


PARTS = [f"p{k}" for k in range(1, DEPTH + 1)]


def scored(nodes: DataFrame, hot: Column) -> DataFrame:
    """(lang, w1..w4, size, a, l, r, score) of each candidate at its lowest cut."""
    words = [F.col(w) for w in WORDS]
    size = sum(((w != 0).cast("int") for w in words), F.lit(0))
    candidates = nodes.select("lang", *WORDS, size.alias("size"), F.col("f").alias("a")).filter("size >= 2")
    made = []
    for n in range(2, DEPTH + 1):
        for k in range(1, n):
            for side, (start, stop) in enumerate(((0, k), (k, n))):
                columns = [F.lit(k).alias("cut"), F.lit(side).alias("side")]
                columns += [p.alias(f"p{i}") for i, p in enumerate(_part(words, start, stop), start=1)]
                made.append(F.when(F.col("size") == n, F.struct(*columns)))
    needs = candidates.select("*", F.inline(F.filter(F.array(*made), lambda x: x.isNotNull())))
    table = nodes.select("lang", *[F.col(w).alias(p) for w, p in zip(WORDS, PARTS)], "f")
    met = _looked_up(needs, table, ["lang", *PARTS], "f", hot)
    cuts = met.groupBy("lang", *WORDS, "size", "a", "cut").agg(
        F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r")
    )
    score = F.expr(f"CAST(CAST(a AS DECIMAL(20,0)) * {SCALE} DIV (CAST(l AS DECIMAL(20,0)) + r) AS BIGINT)")
    lowest = cuts.select("*", score.alias("score")).groupBy("lang", *WORDS, "size", "a").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("_at")
    )
    return lowest.select("lang", *WORDS, "size", "a", "_at.l", "_at.r", "_at.score")


def not_contained(candidates: DataFrame) -> DataFrame:
    """Candidates that no longer candidate holds with INSIDE % of their occurrences."""
    words = [F.col(w) for w in WORDS]
    made = []
    for n in range(3, DEPTH + 1):
        for m in range(2, n):
            for start in range(n - m + 1):
                parts = [p.alias(f"p{i}") for i, p in enumerate(_part(words, start, start + m), start=1)]
                made.append(F.when(F.col("size") == n, F.struct(*parts)))
    longer = candidates.filter("size >= 3").select(
        "lang", F.col("a").alias("_around"), F.inline(F.filter(F.array(*made), lambda x: x.isNotNull()))
    )
    most = longer.groupBy("lang", *PARTS).agg(F.max("_around").alias("_around"))
    most = most.select("lang", *[F.col(p).alias(w) for p, w in zip(PARTS, WORDS)], "_around")
    held = F.expr(f"100 * CAST(_around AS DECIMAL(20,0)) >= {INSIDE} * CAST(a AS DECIMAL(20,0))")
    return candidates.join(most, ["lang", *WORDS], "left").filter(~F.coalesce(held, F.lit(False))).drop("_around")


def spelled_out(rows: DataFrame, words: DataFrame, hot: Column) -> DataFrame:
    """Add ``phrase``: the words of w1..w4 with single spaces between."""
    listed = F.filter(F.array(*WORDS), lambda w: w != 0)
    places = rows.select("lang", *WORDS, F.posexplode(listed).alias("place", "hash"))
    met = _looked_up(places, words.select("lang", "hash", F.col("word"), "n"), ["lang", "hash"], "word", hot)
    phrases = met.groupBy("lang", *WORDS).agg(
        F.array_sort(F.collect_list(F.struct("place", F.col("word").cast("string").alias("word")))).alias("_words")
    )
    text = F.array_join(F.transform("_words", lambda x: x["word"]), " ")
    return rows.join(phrases.select("lang", *WORDS, text.alias("phrase")), ["lang", *WORDS])


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, group_leaves: int = GROUP_LEAVES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases."""
    keep = Written(docs.sparkSession)
    nodes, words = phrase_counts(docs, keep, least, group_leaves)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    n_words = words.agg(F.sum("n")).first()[0] or 0
    bound = n_words // MOST_GROUPS  # fewer than MOST_GROUPS nodes of a depth have more
    candidates = not_contained(scored(nodes, F.col("f") > bound))
    named = spelled_out(keep(candidates), words.filter(F.col("n") >= least), F.col("n") > bound)
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first within shares of a language, so that no task sees all of its phrases
    shares = named.withColumn("_share", F.pmod(F.xxhash64(*WORDS), F.lit(64)))
    some = shares.withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*best)))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*best))
    first = some.filter(F.col("_place") <= top).withColumn("rank", place.cast("long")).filter(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
