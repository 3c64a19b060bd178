"""Class-based bigram scores: words emit from classes that exchange clustering finds.

Tokens are the words of a text, A-Z in lower case, then one end token. All training
documents are counted: every word (by a 64-bit hash), and which words stand next to it. Every
training word has a class of its own evidence. Exchange clustering runs twice:

* the ``symbols`` most frequent words one by one, with one symbol for all the rest: each in
  turn moves to the class that raises the likelihood of the class bigrams most, until none moves;
* then all words together, in rounds over the whole corpus: a round counts the classes before
  and after each word and moves every word to its best class. Rounds go on until the
  likelihood stops rising (or for ``rounds`` rounds); the best round's classes are taken.

    P(word | before) = (1 - u) P(class | class before) count(word) / count(class)

The transition is interpolated with the class frequency (Witten-Bell). Of all probability
u = (n1 + 1) / (N + 1) goes to unseen words, shared by n1 + 1 of them, where n1 words were
seen once. The values of all seen words and these unseen ones sum to 1. An unseen word has no
class; after it classes have their frequencies.

Texts are read twice, to count words and to write them as numbers; rounds and scores read the
numbers. The ``head`` most frequent words have numbers that tasks know, with their classes.
The other words are rows of a table by their hash, each with the words next to it and its class,
which is joined where a text has them; so the vocabulary may grow without limit.
Null and empty texts are the end token alone. Rows equal in id and text are scored alike.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.llm.common import Written, arrow_types
from cohortloom.llm.tokens import CACHE

END = b" "
SYMBOLS = 1024
CLASSES = 48
HEAD = 1 << 18
TURNS = 12
ROUNDS = 12
# A round that raises the likelihood by less than this share of it is the last one.
LEAST_GAIN = 2e-3
# Distinct words and cells a task holds before it hands on its counts, tokens and texts that are read at
# once, the most frequent words, whose cells a task adds up in place, words whose counts meet in one
# group, and cells whose gains are taken at once.
HELD_WORDS = 1 << 19
HELD = 1 << 21
STEP = 1 << 19
TEXTS = 512
FREQUENT = 1 << 13
BLOCK = 1024
CELLS = 1 << 15
# Counts up to this one have their gains in a table.
SMALL = 4
# A neighbour that is none of the numbered words.
OTHER = -1
MODULUS, HELD_OUT = 7, 2


def hash_of(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def tokens(text: str | None) -> list[bytes]:
    """The tokens of a text, the end token last."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    found.append(END)
    return found


def held_out(id_column: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % MODULUS == HELD_OUT


def word_counts(texts: DataFrame) -> DataFrame:
    """(hash, n) of all tokens."""
    schema = "hash long, n long"
    kinds = arrow_types(texts.sparkSession, schema)

    def total(held: Counter) -> pa.RecordBatch:
        found = np.fromiter(map(hash_of, held), np.uint64, len(held))
        n = np.fromiter(held.values(), np.int64, len(held))
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64), kinds["hash"]), pa.array(n, kinds["n"])], names=list(kinds))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for k in range(0, batch.num_rows, TEXTS):
                for text in batch.column(0).slice(k, TEXTS).to_pylist():
                    held.update(tokens(text))
                if len(held) >= HELD_WORDS:
                    yield total(held)
                    held = Counter()
        if held:
            yield total(held)

    return texts.mapInArrow(count, schema).groupBy("hash").agg(F.sum("n").alias("n"))


# --- texts as numbers -------------------------------------------------------------------


def flat(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of a binary or list column one after the other, and where each row starts (and the last ends)."""
    if pa.types.is_list(column.type):
        return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False), _starts(column)
    starts = _starts(column)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    size = np.dtype(kind).itemsize
    return data[column_start(column) : column_start(column) + int(starts[-1])].view(kind), starts // size


def column_start(column: pa.Array) -> int:
    return int(np.frombuffer(column.buffers()[1], np.int32)[column.offset]) if len(column) else 0


def _starts(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros(1, np.int64)
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return at - at[0]


def packed(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The reverse of ``flat``: a binary column."""
    values = np.ascontiguousarray(values)
    offsets = (starts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


class Numbers(dict):
    """Word to a number of its own, by the order of first sight."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


CODED = "id long, doc long, train boolean, codes binary, others binary"


def coded(documents: DataFrame, head: np.ndarray, id_column: str, text_column: str) -> DataFrame:
    """(id, doc, train, codes, others): a text's tokens as places in ``head``; the other ones are -1, their hashes apart."""
    kinds = arrow_types(documents.sparkSession, CODED)
    order = np.argsort(head)
    sent = documents.sparkSession.sparkContext.broadcast((head[order], order.astype(np.int32)))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, place = sent.value
        numbers = Numbers()
        hashes, codes = np.empty(0, np.uint64), np.empty(0, np.int32)
        for whole in batches:
            for k in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(k, TEXTS)
                if len(numbers) >= CACHE:
                    numbers.clear()
                    hashes, codes = hashes[:0], codes[:0]
                found = [tokens(t) for t in batch.column(3).to_pylist()]
                starts = np.append(0, np.cumsum([len(f) for f in found]))
                at = np.fromiter(map(numbers.__getitem__, chain.from_iterable(found)), np.int64, int(starts[-1]))
                fresh = list(islice(reversed(numbers), len(numbers) - len(hashes)))[::-1]
                new = np.fromiter(map(hash_of, fresh), np.uint64, len(fresh))
                near = np.searchsorted(known, new)
                near[near == len(known)] = 0
                same = known[near] == new if len(known) else np.zeros(len(new), bool)
                code_of = np.full(len(new), OTHER, np.int32)
                code_of[same] = place[near[same]]
                hashes, codes = np.append(hashes, new), np.append(codes, code_of)
                coded_at = codes[at]
                other = coded_at == OTHER
                before = np.append(0, np.cumsum(other))[starts]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], packed(coded_at, starts), packed(hashes[at[other]], before)], names=list(kinds)
                )

    rows = documents.select(
        F.monotonically_increasing_id().alias("id"), F.col(id_column).cast("long").alias("doc"),
        (~held_out(id_column)).alias("train"), F.col(text_column).alias("text"),
    )
    return rows.mapInArrow(code, CODED)


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, TEXTS):
            yield batch.slice(k, TEXTS)


def sequences(batch: pa.RecordBatch, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the columns codes and others: each token's code, the one before it, the hash of those without a code, starts of texts."""
    codes, starts = flat(batch.column("codes"), np.int32)
    before = np.append(np.int32(end), codes[:-1])
    before[starts[:-1]] = end
    return codes, before, flat(batch.column("others"), np.uint64)[0], starts


def rest_words(train: DataFrame, end: int) -> DataFrame:
    """(hash, before, after, next): each place of a word without a code; ``next`` is the hash after it where that has no code too."""
    schema = "hash long, before int, after int, next long"
    kinds = arrow_types(train.sparkSession, schema)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            codes, before, others, _ = sequences(batch, end)
            at = np.flatnonzero(codes == OTHER)
            if not len(at):
                continue
            # the end token has a code wherever there are training texts, so a next token is of the same text
            after = codes[at + 1]
            following = np.append(others[1:], np.uint64(0)).view(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(others.view(np.int64), kinds["hash"]), pa.array(before[at], kinds["before"]), pa.array(after, kinds["after"]),
                pa.array(following, kinds["next"], mask=after != OTHER),
            ], names=list(kinds))

    return train.select("codes", "others").mapInArrow(find, schema)


# --- classes ----------------------------------------------------------------------------


def pair_counts(train: DataFrame, symbols: int, end: int) -> np.ndarray:
    """How often each of the first ``symbols`` codes, or one symbol for all others, follows each; a text starts after an end token."""
    schema = "pair long, n long"
    kinds = arrow_types(train.sparkSession, schema)
    size = symbols + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size * size, np.int64)
        for batch in pieces(batches):
            codes, before, _, _ = sequences(batch, end)
            # as unsigned numbers words without a code come last
            at = [np.minimum(c.view(np.uint32), symbols).astype(np.int64) for c in (before, codes)]
            counts += np.bincount(at[0] * size + at[1], minlength=size * size)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found, kinds["pair"]), pa.array(counts[found], kinds["n"])], names=list(kinds))

    found = train.select("codes", "others").mapInArrow(count, schema).groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size * size, np.int64)
    counts[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return counts.reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(counts: np.ndarray, classes: int = CLASSES, turns: int = TURNS) -> np.ndarray:
    """The class of each symbol.

    The likelihood of class bigrams is, up to a constant, the sum of n log n over the pairs
    of classes minus that over the classes before and after.
    """
    counts = counts.astype(np.float64)
    n = len(counts)
    order = np.argsort(-(counts.sum(0) + counts.sum(1)), kind="stable")
    of = np.empty(n, np.int64)
    of[order] = np.arange(n) % classes
    member = np.zeros((n, classes))
    member[np.arange(n), of] = 1.0
    pairs = member.T @ counts @ member
    after, before = counts @ member, (member.T @ counts).T  # per symbol: what follows, what precedes
    for _ in range(turns):
        moved = 0
        for w in order.tolist():
            own, out, into, self_ = of[w], after[w].copy(), before[w].copy(), counts[w, w]
            if not out.any() and not into.any():
                continue
            pairs[own] -= out
            pairs[:, own] -= into
            pairs[own, own] += self_
            # without itself the symbol meets the other members of its own class only
            out[own] -= self_
            into[own] -= self_
            rows, columns = pairs.sum(1), pairs.sum(0)
            # joining class k changes row k, column k and its crossing
            row = _xlogx(pairs + out[None, :]) - _xlogx(pairs)
            column = _xlogx(pairs + into[:, None]) - _xlogx(pairs)
            cross = np.diag(pairs)
            gain = row.sum(1) + column.sum(0) - np.diag(row) - np.diag(column)
            gain += _xlogx(cross + out + into + self_) - _xlogx(cross)
            total_out, total_in = out.sum() + self_, into.sum() + self_
            gain -= _xlogx(rows + into + (total_out)) - _xlogx(rows)
            gain -= _xlogx(columns + out + (total_in)) - _xlogx(columns)
            # other classes' totals change by the same amounts whichever class is joined
            others = _xlogx(rows + into) - _xlogx(rows)
            gain -= others.sum() - others
            others = _xlogx(columns + out) - _xlogx(columns)
            gain -= others.sum() - others
            best = int(gain.argmax())
            if gain[best] <= gain[own] + 1e-9:
                best = own
            pairs[best] += out
            pairs[:, best] += into
            pairs[best, best] += self_
            if best != own:
                moved += 1
                of[w] = best
                after[:, own] -= counts[:, w]
                after[:, best] += counts[:, w]
                before[:, own] -= counts[w]
                before[:, best] += counts[w]
        if not moved:
            break
    return of


def likelihood(pairs: np.ndarray) -> float:
    """Of class bigrams, up to a constant."""
    return float(_xlogx(pairs).sum() - _xlogx(pairs.sum(0)).sum() - _xlogx(pairs.sum(1)).sum())


def best_classes(
    word: np.ndarray, side: np.ndarray, cls: np.ndarray, n: np.ndarray, own: np.ndarray, total: np.ndarray, pairs: np.ndarray
) -> np.ndarray:
    """The class of the highest likelihood for each word, all others staying where they are.

    Words are numbers below len(own); sorted by word, a cell says how often class ``cls`` is after
    (side 0) or before (side 1) a word. Each cell of the class bigrams is changed by itself;
    a word is first taken out of its own class.
    """
    pairs = pairs.astype(np.float64)
    kinds = len(pairs)
    members = [pairs.sum(1), pairs.sum(0)]
    # by side: row c holds the bigrams of class c with each class a word may join
    tables = [np.ascontiguousarray(pairs.T), pairs]
    logs = [_xlogx(t) for t in tables]
    steps = [np.stack([_xlogx(t + k) - l for k in range(SMALL + 1)]) for t, l in zip(tables, logs)]
    out = np.empty(len(own), np.int64)
    ends = np.searchsorted(word, np.arange(len(own) + 1))
    first = 0
    while first < len(own):
        # as many words as have ``CELLS`` cells, one at least
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + CELLS, "right")) - 1)
        last = min(last, first + CELLS)
        lo, hi = ends[first], ends[last]
        gain = np.zeros((hi - lo, kinds))
        mine = own[word[lo:hi]]
        for s in (0, 1):
            at = np.flatnonzero(side[lo:hi] == s)
            c, times = cls[lo:hi][at], n[lo:hi][at].astype(np.float64)
            few = times <= SMALL
            gain[at[few]] = steps[s][times[few].astype(np.int64), c[few]]
            gain[at[~few]] = _xlogx(tables[s][c[~few]] + times[~few, None]) - logs[s][c[~few]]
            without = tables[s][c, mine[at]]
            gain[at, mine[at]] = _xlogx(without) - _xlogx(np.maximum(without - times, 0.0))
        words_ = np.arange(first, last)
        mean = np.zeros((len(words_), kinds))
        filled = ends[first:last] < ends[first + 1 : last + 1]
        if filled.any():
            mean[filled] = np.add.reduceat(gain, ends[first:last][filled] - lo, axis=0)
        t, mine = total[first:last].astype(np.float64), own[first:last]
        for m in members:
            mean -= _xlogx(m[None, :] + t[:, None]) - _xlogx(m)[None, :]
            # the own class has the word already
            row = np.arange(len(words_))
            mean[row, mine] += _xlogx(m[mine] + t) - _xlogx(m[mine]) - (_xlogx(m[mine]) - _xlogx(np.maximum(m[mine] - t, 0.0)))
        best = mean.argmax(1)
        stays = mean[row, best] <= mean[row, mine] + 1e-9
        out[first:last] = np.where(stays | ~filled, mine, best)
        first = last
    return out


CELL = "block int, keys binary, n binary"
# Codes next to a word are binary columns; a tie is a neighbour without a code as one number, (count, side, class).
REST = "hash long, cls int, n long, befores binary, afters binary"
TIES = "array<bigint>"


def _unique(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, and how often they occur (or the sums of ``n``)."""
    if n is None:
        return np.unique(keys, return_counts=True)
    found, at = np.unique(keys, return_inverse=True)
    return found, np.bincount(at, weights=n, minlength=len(found)).astype(np.int64)


class Cells:
    """Counts of cells (word, side, class) as they are met, and of class bigrams; the memory is bounded."""

    def __init__(self, kinds: int) -> None:
        self.kinds, self.width = kinds, BLOCK * 2 * kinds
        self.start()

    def start(self) -> None:
        self.often = np.zeros(FREQUENT * 2 * self.kinds, np.int64)
        self.pairs = np.zeros(self.kinds * self.kinds, np.int64)
        self.held: list[np.ndarray] = []

    def add(self, keys: np.ndarray) -> None:
        often = keys < len(self.often)
        self.often += np.bincount(keys[often], minlength=len(self.often))
        self.held.append(keys[~often])

    def full(self) -> bool:
        return sum(map(len, self.held)) >= HELD

    def rows(self) -> pa.RecordBatch:
        """(block, keys, n): cells by groups of words, class bigrams as group -1."""
        seldom, times = _unique(np.concatenate(self.held)) if self.held else (np.empty(0, np.int64),) * 2
        at, pair = np.flatnonzero(self.often), np.flatnonzero(self.pairs)
        keys, n = np.append(at, seldom), np.append(self.often[at], times)
        block = keys // self.width
        blocks, first = np.unique(block, return_index=True)
        starts = np.concatenate([[0], first + len(pair), [len(keys) + len(pair)]]) if len(keys) else np.array([0, len(pair)])
        values = [np.append(pair, keys - block * self.width).astype(np.uint32), np.append(self.pairs[pair], n).astype(np.int64)]
        self.start()
        return pa.RecordBatch.from_arrays(
            [pa.array(np.append(-1, blocks).astype(np.int32)), *[packed(v, starts) for v in values]], names=["block", "keys", "n"]
        )


def cells(train: DataFrame, rest: Sequence[DataFrame], classes_of: np.ndarray, kinds: int, end: int) -> DataFrame:
    """(block, keys, n): the classes next to each word of the head, and the bigrams of classes (block -1)."""
    spark = train.sparkSession
    sent = spark.sparkContext.broadcast(classes_of)

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = sent.value
        held = Cells(kinds)
        for batch in batches:
            codes, before, _, _ = sequences(batch, end)
            for k in range(0, len(codes), STEP):
                a, b = before[k : k + STEP], codes[k : k + STEP]
                both = (a != OTHER) & (b != OTHER)
                a, b = a[both].astype(np.int64), b[both].astype(np.int64)
                of_a, of_b = of[a], of[b]
                held.pairs += np.bincount(of_a * kinds + of_b, minlength=kinds * kinds)
                held.add(a * (2 * kinds) + of_b)
                held.add(b * (2 * kinds) + kinds + of_a)
                if held.full():
                    yield held.rows()
        yield held.rows()

    def of_rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = sent.value
        held = Cells(kinds)
        for batch in batches:
            own = batch.column("cls").to_numpy().astype(np.int64)
            for name, side in (("befores", 0), ("afters", 1)):
                near, starts = flat(batch.column(name), np.int32)
                near, mine = near.astype(np.int64), np.repeat(own, np.diff(starts))
                # the word is after those before it, and before those after it
                held.add(near * (2 * kinds) + side * kinds + mine)
                both = of[near] * kinds + mine if side == 0 else mine * kinds + of[near]
                held.pairs += np.bincount(both, minlength=kinds * kinds)
            mine, side, near, n = _tied(batch, kinds)
            after = side == 0
            held.pairs += np.bincount(own[mine[after]] * kinds + near[after], weights=n[after], minlength=kinds * kinds).astype(np.int64)
            if held.full():
                yield held.rows()
        yield held.rows()

    def total(rows: pa.Table) -> pa.Table:
        keys, n = [np.concatenate([flat(c, kind)[0] for c in rows.column(name).chunks]) for name, kind in (("keys", np.uint32), ("n", np.int64))]
        found, times = _unique(keys, n)
        whole = np.array([0, len(found)])
        return pa.Table.from_arrays(
            [rows.column("block").slice(0, 1).combine_chunks(), packed(found, whole), packed(times, whole)], names=["block", "keys", "n"]
        )

    found = train.select("codes", "others").mapInArrow(of_texts, CELL)
    for words in rest:
        found = found.unionByName(words.mapInArrow(of_rest, CELL))
    return found.groupBy("block").applyInArrow(total, CELL)


def _tied(batch: pa.RecordBatch, kinds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the column ties: number of the row, side, class and count of each neighbour without a code."""
    ties, starts = flat(batch.column("ties"), np.int64)
    cell = ties % (2 * kinds)
    return np.repeat(np.arange(batch.num_rows), np.diff(starts)), cell // kinds, cell % kinds, ties // (2 * kinds)


def head_moves(found: DataFrame, classes_of: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The best class of each word of the head."""
    schema = "code long, cls long"
    types = arrow_types(found.sparkSession, schema)
    kinds = len(pairs)
    sent = found.sparkSession.sparkContext.broadcast((classes_of, counts, pairs))

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, total, pairs = sent.value
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                lo = one.column("block")[0].as_py() * BLOCK
                hi = min(lo + BLOCK, len(of))
                keys, n = flat(one.column("keys"), np.uint32)[0].astype(np.int64), flat(one.column("n"), np.int64)[0]
                cell = keys % (2 * kinds)
                best = best_classes(keys // (2 * kinds), cell // kinds, cell % kinds, n, of[lo:hi], total[lo:hi], pairs)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(lo, hi), types["code"]), pa.array(best, types["cls"])], names=list(types))

    moved = found.filter("block >= 0").mapInArrow(move, schema).toArrow()  # a row per word of the head at most
    out = classes_of.copy()
    out[moved.column("code").to_numpy()] = moved.column("cls").to_numpy()
    return out


def rest_moves(rest: DataFrame, classes_of: np.ndarray, pairs: np.ndarray) -> DataFrame:
    """The other words with their best classes."""
    kinds = len(pairs)
    sent = rest.sparkSession.sparkContext.broadcast((classes_of, pairs))

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, pairs = sent.value
        for batch in batches:
            own = batch.column("cls").to_numpy().astype(np.int64)
            keys, times = [], []
            for name, side in (("afters", 0), ("befores", 1)):
                near, starts = flat(batch.column(name), np.int32)
                word = np.repeat(np.arange(len(own)), np.diff(starts))
                keys.append((word * 2 + side) * kinds + of[near])
                times.append(np.ones(len(word), np.int64))
            word, side, near, n = _tied(batch, kinds)
            found, n = _unique(np.concatenate([*keys, (word * 2 + side) * kinds + near]), np.concatenate([*times, n]))
            total = batch.column("n").to_numpy()
            cell = found % (2 * kinds)
            best = best_classes(found // (2 * kinds), cell // kinds, cell % kinds, n, own, total, pairs)
            yield pa.RecordBatch.from_arrays(
                [batch.column("hash"), pa.array(best.astype(np.int32)), *(batch.column(c) for c in ("n", "befores", "afters"))],
                names=["hash", "cls", "n", "befores", "afters"],
            )

    return rest.mapInArrow(move, REST)


def near_words(places: DataFrame, cls: int) -> DataFrame:
    """(hash, cls, n, befores, afters, linked): each word without a code once, with the codes next to it; linked if a neighbour has none."""
    schema = f"{REST}, linked boolean"
    kinds = arrow_types(places.sparkSession, schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            linked, lists, total = np.zeros(rows, bool), [], np.zeros(rows, np.int64)
            for name in ("befores", "afters"):
                near, starts = flat(batch.column(name), np.int32)
                named = near != OTHER
                held = np.append(0, np.cumsum(named))[starts]
                lists.append(packed(near[named], held))
                total = np.diff(starts)
                linked |= np.diff(held) < total
            yield pa.RecordBatch.from_arrays(
                [batch.column("hash"), pa.array(np.full(rows, cls, np.int32)), pa.array(total), *lists, pa.array(linked)], names=list(kinds)
            )

    lists = [F.collect_list(c).alias(f"{c}s") for c in ("before", "after")]
    return places.groupBy("hash").agg(*lists).mapInArrow(pack, schema)


def tied(rest: DataFrame, edges: DataFrame, kinds: int) -> DataFrame:
    """Words with the classes of their neighbours that have no code."""
    of = rest.select("hash", "cls")

    def tie(side: int) -> Column:
        return (F.col("n") * (2 * kinds) + side * kinds + F.col("cls")).alias("tie")

    after = edges.join(of.withColumnRenamed("hash", "next"), "next").select("hash", tie(0))
    before = edges.join(of, "hash").select(F.col("next").alias("hash"), tie(1))
    ties = after.unionByName(before).groupBy("hash").agg(F.collect_list("tie").alias("ties"))
    return rest.join(ties, "hash")


def cluster(
    train: DataFrame, counts: np.ndarray, whole: bool, symbols: int, kinds: int, end: int, rounds: int, keep: Written
) -> tuple[np.ndarray, list[DataFrame], np.ndarray]:
    """Classes of the head, the other words with theirs, and the class bigrams.

    ``counts`` are those of the head; ``whole`` if it is all words. Of the other words those that stand
    next to one another are a table of their own: only their neighbours' classes are joined each round.
    """
    core = min(symbols, len(counts))
    first = exchange(pair_counts(train, core, end), kinds)
    of = np.full(len(counts), first[core])
    of[:core] = first[:core]
    rest: list[DataFrame] = []
    edges = None
    if not whole:
        places = keep(rest_words(train, end))
        edges = keep(places.filter("next is not null").groupBy("hash", "next").agg(F.count(F.lit(1)).alias("n")))
        words = keep(near_words(places, int(first[core])))
        keep.drop(places)
        alone = words.filter("NOT linked").drop("linked").withColumn("ties", F.array().cast(TIES))
        rest = [alone, keep(tied(words.filter("linked").drop("linked"), edges, kinds))]
    best: tuple[float, np.ndarray, list[DataFrame], np.ndarray] | None = None
    for turn in range(rounds + 1):
        found = keep(cells(train, rest, of, kinds, end))
        pairs = np.zeros(kinds * kinds, np.int64)
        for row in found.filter("block = -1").collect():  # one row
            pairs[np.frombuffer(row["keys"], np.uint32)] = np.frombuffer(row["n"], np.int64)
        pairs = pairs.reshape(kinds, kinds)
        now = likelihood(pairs.astype(np.float64))
        last = turn == rounds or (best is not None and now < best[0] + LEAST_GAIN * abs(best[0]))
        if best is None or now > best[0]:
            if best is not None:
                keep.drop(*best[2])
            best = now, of, rest, pairs
        if last:
            break
        moved = [rest_moves(words, of, pairs) for words in rest]
        if moved:
            words = keep(moved[1])
            rest = [keep(moved[0]).withColumn("ties", F.array().cast(TIES)), keep(tied(words, edges, kinds))]
            keep.drop(words)
        of = head_moves(found, of, counts, pairs)
        keep.drop(found)
    return best[1], best[2], best[3]


def transitions(counts: np.ndarray, of: np.ndarray, classes: int, unseen: float) -> np.ndarray:
    """log10 of (1 - u) P(class | class before) / count(class), by (before, class)."""
    member = np.zeros((len(of), classes))
    member[np.arange(len(of)), of] = 1.0
    pairs = member.T @ counts @ member
    total = pairs.sum(0)
    share = total / max(total.sum(), 1.0)
    rows, kinds = pairs.sum(1, keepdims=True), (pairs > 0).sum(1, keepdims=True)
    mixed = (pairs + kinds * share) / np.maximum(rows + kinds, 1.0)
    mixed = np.where(rows > 0, mixed, share)
    with np.errstate(divide="ignore"):
        return np.log10((1 - unseen) * mixed) - np.log10(np.maximum(total, 1.0))


# --- scores -----------------------------------------------------------------------------

PARTS = "id long, hash long, before int, after int, n long, known long, score double, base double"


def class_scores(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    symbols: int = SYMBOLS,
    classes: int = CLASSES,
    head: int = HEAD,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per document."""
    spark = documents.sparkSession
    keep = Written(spark)
    vocabulary = keep(word_counts(documents.filter(~held_out(id_column)).select(F.col(text_column).alias("text"))))
    n_all, n_kinds, n_once = (x or 0 for x in vocabulary.agg(F.sum("n"), F.count(F.lit(1)), F.sum((F.col("n") == 1).cast("long"))).first())
    ends = int(np.uint64(hash_of(END)).view(np.int64))
    # the end token has a code, however many words are more frequent
    top = vocabulary.orderBy(F.col("hash") != ends, F.desc("n"), "hash").limit(max(head, symbols)).toArrow()  # ``head`` rows at most
    top_n = top.column("n").to_numpy().astype(np.int64)
    top_hash = top.column("hash").to_numpy().view(np.uint64)
    order = np.lexsort((top_hash.view(np.int64), -top_n))
    top_hash, top_n = top_hash[order], top_n[order]
    end = int(np.flatnonzero(top_hash == np.uint64(ends % (1 << 64)))[0]) if n_all else OTHER
    keep.drop(vocabulary)
    texts = keep(coded(documents, top_hash, id_column, text_column))
    of, rest, pairs = np.zeros(0, np.int64), [], np.zeros((classes, classes), np.int64)
    if n_all:
        of, rest, pairs = cluster(texts.filter("train"), top_n, len(top_n) == n_kinds, symbols, classes, end, rounds, keep)
    unseen = (n_once + 1) / (n_all + 1)
    log_unseen = float(np.log10(unseen / (n_once + 1)))
    log_all = float(np.log10(max(n_all + n_kinds + 1, 1)))
    # the last row is for unseen words, which have no class: all classes follow by their frequency
    table = transitions(pairs, np.arange(classes), classes, unseen)
    with np.errstate(divide="ignore"):
        alone = np.where(pairs.sum(0) > 0, np.log10((1 - unseen) / max(n_all, 1)), 0.0)
    table = np.vstack([table, alone])
    sent = spark.sparkContext.broadcast((of, top_n, table))
    kinds = arrow_types(spark, PARTS)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per text for its words with a code, and one for each place of another word with the classes around it."""
        of, counts, table = sent.value
        logs = np.log10(counts)
        bases = np.log10(counts + 1) - log_all
        for batch in pieces(batches):
            codes, before, others, starts = sequences(batch, end)
            named = codes != OTHER
            both = named & (before != OTHER)
            score, base = np.zeros(len(codes)), np.zeros(len(codes))
            score[named] = logs[codes[named]]
            score[both] += table[of[before[both]], of[codes[both]]]
            base[named] = bases[codes[named]]
            # a text has its end token at least, so no sum is over nothing
            sums = [np.add.reduceat(x, starts[:-1]) for x in (named.astype(np.int64), score, base)]
            at = np.flatnonzero(~named)
            after = np.append(codes[1:], np.int32(OTHER))[at]
            after[np.isin(at + 1, starts)] = OTHER
            ids = batch.column("id").to_numpy()
            n, m = len(ids), len(at)

            def near(found: np.ndarray) -> np.ndarray:
                out = np.full(m, OTHER, np.int32)
                out[found != OTHER] = of[found[found != OTHER]]
                return out

            columns = {
                "id": np.append(ids, np.repeat(ids, np.diff(flat(batch.column("others"), np.uint64)[1]))),
                "hash": pa.array(np.append(np.zeros(n, np.int64), others.view(np.int64)), kinds["hash"], mask=np.arange(n + m) < n),
                "before": np.append(np.full(n, OTHER, np.int32), near(before[at])),
                "after": np.append(np.full(n, OTHER, np.int32), near(after)),
                "n": np.append(np.diff(starts), np.zeros(m, np.int64)),
                "known": np.append(sums[0], np.zeros(m, np.int64)),
                "score": np.append(sums[1], np.zeros(m)), "base": np.append(sums[2], np.zeros(m)),
            }
            yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, kinds[k]) for k, v in columns.items()], names=list(kinds))

    def rest_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words without a code that stand next to one another."""
        for batch in pieces(batches):
            codes, before, others, starts = sequences(batch, end)
            at = np.flatnonzero(codes == OTHER)
            joint = before[at] == OTHER
            # with no training text the end token before a text has no code, and all words are unseen
            joint &= ~np.isin(at, starts[:-1])
            ids = np.repeat(batch.column("id").to_numpy(), np.diff(flat(batch.column("others"), np.uint64)[1]))
            hashes = others.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[joint]), pa.array(np.append(0, hashes[:-1])[joint]), pa.array(hashes[joint])], names=["id", "prior", "hash"]
            )

    # values of the table by (class before, class), as one constant
    values = F.split(F.lit(",".join(map(repr, table.ravel().tolist()))), ",").cast("array<double>")

    def transition(before: Column, after: Column) -> Column:
        return F.get(values, before * classes + after)

    found = texts.select("id", "codes", "others").mapInArrow(parts, PARTS)
    known = spark.createDataFrame([], "hash long, cls int, c long")
    for words in rest:
        known = known.unionByName(words.select("hash", "cls", F.col("n").alias("c")))
    none = F.lit(0.0)
    seen, other = F.col("c").isNotNull(), F.col("hash").isNotNull()
    # rows of whole texts have no hash; they join nothing and keep their sums
    met = found.join(known, "hash", "left").select(
        "id", "n",
        F.when(other, seen.cast("long")).otherwise(F.col("known")).alias("known"),
        F.when(other, F.log10(F.coalesce("c", F.lit(0)) + 1) - F.lit(log_all)).otherwise(F.col("base")).alias("base"),
        F.when(
            other,
            F.when(seen, F.log10("c") + F.when(F.col("before") >= 0, transition(F.col("before"), F.col("cls"))).otherwise(none)).otherwise(F.lit(log_unseen))
            + F.when(F.col("after") >= 0, transition(F.coalesce("cls", F.lit(classes)), F.col("after"))).otherwise(none),
        ).otherwise(F.col("score")).alias("score"),
    )
    if rest:
        joint = texts.select("id", "codes", "others").mapInArrow(rest_pairs, "id long, prior long, hash long")
        prior = known.select(F.col("hash").alias("prior"), F.col("cls").alias("first"))
        joint = joint.join(known, "hash").join(prior, "prior", "left").select(
            "id", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("known"), none.alias("base"),
            transition(F.coalesce("first", F.lit(classes)), F.col("cls")).alias("score"),
        )
        met = met.unionByName(joint)
    summed = met.groupBy("id").agg(*[F.sum(c).alias(c) for c in ("n", "known", "base", "score")])
    return texts.select("id", "doc", "train").join(summed, "id").select(
        F.col("doc").alias("doc_id"),
        (~F.col("train")).alias("held_out"),
        F.col("n").alias("n_tokens"),
        F.col("known").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )
