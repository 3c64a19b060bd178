"""Token ids as binary shards with a minimal perfect hash index over the document keys.

Documents are sorted by id over the cluster (ties by a hash of the text, so that even one
id with a third of all rows is split) and each range is encoded and written in shards of
about ``shard_tokens`` ids. A shard is one row of a Parquet table, written by Spark so
that a lost executor costs a retry and any store that Spark reaches will do:

    place, shard   range of the sort and number within it; ascending (place, shard) is id order
    first, last    smallest and largest document id, by which a key finds its shard
    n_tokens       ids in the payload
    payload        the ids, little-endian unsigned 16 or 32 bit, one after the other
    keys           document ids in payload order, little-endian signed 64 bit
    levels, bits   the hash function: bits per level and the level bit sets
    slots          one record per key: fingerprint uint32, copies uint32, offset uint64, length uint64

The hash function is built level by level: every key hashes into the level's bit set, those
that meet no other key set their bit, the others go on to the next level. The number of set
bits before a key's bit is its slot, so n keys take exactly n slots. A key is looked up by
its shard's id range, one bit test per level and one slot; the stored fingerprint tells
foreign keys apart. Documents with equal ids in one shard share a slot: ``copies`` of them
start at ``offset`` and ``length`` is that of all of them together.

Null texts are empty documents (the end id alone); a null id is kept as the smallest id and
comes back as null.
"""

from __future__ import annotations

import functools
import os
import re
import string
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cohortloom.llm.common import arrow_types
from cohortloom.session import run_folder

END_ID = 2
SHARD_TOKENS = 1 << 20
GAMMA = 2.0
# Pieces of text whose ids a worker remembers; the memory is emptied when it is full.
CACHE = 1 << 20
NULL_KEY = -(1 << 63)
SLOT = np.dtype([("fingerprint", "<u4"), ("copies", "<u4"), ("offset", "<u8"), ("length", "<u8")])

SHARD_SCHEMA = (
    "place int, shard int, first long, last long, n_tokens long, wide boolean, payload binary,"
    " lengths binary, keys binary, levels array<long>, bits binary, slots binary"
)
# In a run of blanks a cut would change ids.
UNSAFE = re.compile(r"\s\s")
SPACE = re.compile(r"\s")
# How a byte-level vocabulary writes a blank.
BLANK = "\u0120"
SYMBOLS = string.punctuation
# Letters up to here are letters in every version of Unicode.
LETTERS = "\u024f"


class Encoder:
    """Texts to ids by a byte-level tokenizer file, remembering the pieces between single blanks.

    The tokenizer splits before a blank or line end that follows a non-blank, so a text
    without runs of blanks is the same as its pieces, each with the blank or line end before
    it; other texts go whole. It also splits between a letter and a symbol, so a new piece is
    learnt without the symbols at its end, and those by themselves.
    """

    def __init__(self, path: str, cache: int = CACHE) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache = cache
        self.known: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}
        vocabulary = self.tokenizer.get_vocab()
        self.after_blank = np.zeros(max(vocabulary.values()) + 1, bool)
        self.after_blank[[i for token, i in vocabulary.items() if token[0] == BLANK]] = True
        self.line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _lines(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces without blanks inside, in one go: each as a line, cut at the line ends."""
        found = self.tokenizer.encode_batch_fast(["".join(pieces)], add_special_tokens=False)[0].ids
        ids = np.array(found, "<u4")
        ends = np.append(np.flatnonzero(ids == self.line_end)[1:], len(ids)) * 4
        flat, start, out = ids.tobytes(), 0, []
        for end in ends.tolist():
            out.append(flat[start:end])
            start = end
        return out

    def _words(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that are all letters, each after a blank: the tokenizer takes each as one word."""
        found = self.tokenizer.encode_batch_fast([" " + " ".join(pieces)], add_special_tokens=False)[0]
        ids = np.array(found.ids, "<u4")
        ends = np.append(np.flatnonzero(self.after_blank[ids])[1:], len(ids)) * 4
        flat, start, out = ids.tobytes(), 0, []
        for end in ends.tolist():
            out.append(flat[start:end])
            start = end
        return out

    def _learn(self, new: list[str]) -> None:
        """Remember the ids of new pieces; a piece stands for itself after a blank or a line end."""
        known, tails = self.known, self.tails
        fresh = [p for p in new if p.isalpha()]
        taken = set(fresh)
        made = []
        for p in new:
            if p in taken:
                continue
            core = p.rstrip(SYMBOLS)
            if core and core[-1] <= LETTERS and core[-1].isalpha():
                end = p[len(core):]
                if end:
                    made.append((p, core, end))
                if core not in known and core not in taken:
                    fresh.append(core)
                    taken.add(core)
            else:
                fresh.append(p)
        ends = list({end for _, _, end in made} - tails.keys())
        tails.update(zip(ends, self._whole(ends)))
        words = [p for p in fresh if p.isalpha() and (p.isascii() or max(p) <= LETTERS)]
        taken = set(words)
        lines = [p for p in fresh if p[:1] == "\n" and p[1:] and not SPACE.search(p, 1)]
        plain = [p for p in fresh if p and p not in taken and not SPACE.search(p)]
        for lot, head in ((words, None), (lines, ""), (plain, "\n ")):
            for lo in range(0, len(lot), 512):
                part = lot[lo : lo + 512]
                found = self._words(part) if head is None else self._lines([head + p for p in part])
                if len(found) == len(part):
                    known.update(zip(part, [f[4:] for f in found] if head else found))
        rest = [p for p in fresh if p not in known]
        texts = [p[1:] if p[:1] == " " else p if p[:1] == "\n" else f" {p}" for p in rest]
        known.update(zip(rest, self._whole(texts)))
        known.update([(p, known[core] + tails[end]) for p, core, end in made])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > self.cache:
            self.known, self.tails = {}, {"": b""}
        known = self.known
        out: list[bytes | None] = [None] * len(texts)
        cut: dict[int, list[str]] = {}
        seen: set[str] = set()
        for i, text in enumerate(texts):
            # strings of special tokens may reach over a blank
            if "<|" not in text and not UNSAFE.search(text):
                first, *rest = text.replace("\n", " \n").split(" ")
                # no other piece holds a blank, so the first is told apart by one
                cut[i] = [f" {first}", *rest]
                seen.update(cut[i])
        self._learn(list(seen.difference(known)))
        for i, parts in cut.items():
            out[i] = b"".join(map(known.__getitem__, parts))
        left = [i for i, found in enumerate(out) if found is None]
        for i, found in zip(left, self._whole([texts[i] for i in left])):
            out[i] = found
        return [np.frombuffer(found, "<u4") for found in out]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process, so that later tasks know the pieces of earlier ones."""
    return Encoder(path)


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of 64-bit keys."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


def build_hash(keys: np.ndarray, gamma: float = GAMMA) -> tuple[list[int], bytes]:
    """Bits per level and the packed bit sets of a minimal perfect hash of distinct keys."""
    levels, sets, left = [], [], keys
    while len(left):
        size = max(64, -(-int(gamma * len(left)) // 64) * 64)
        at = (mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(size)
        sets.append(np.packbits(alone))
        left = left[~alone[at]]
    return levels, b"".join(s.tobytes() for s in sets)


class Hash:
    """Slots of keys by a hash from ``build_hash``; -1 where no level has the key's bit."""

    def __init__(self, levels: Iterable[int], bits: bytes) -> None:
        self.levels = list(levels)
        self.bits = np.unpackbits(np.frombuffer(bits, np.uint8))
        self.rank = np.append(0, np.cumsum(self.bits))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        found, start = np.full(len(keys), -1, np.int64), 0
        for level, size in enumerate(self.levels):
            left = np.flatnonzero(found < 0)
            at = start + (mixed(keys[left], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[at] == 1
            found[left[hit]] = self.rank[at[hit]]
            start += size
        return found


def pack(place: int, shard: int, keys: list[int], ids: list[np.ndarray]) -> dict:
    """One shard as a row."""
    flat = np.concatenate(ids)
    wide = bool(flat.max() >= 1 << 16)
    named = np.array(keys, np.int64)
    lengths = np.array([len(x) for x in ids], np.uint64)
    ends = np.cumsum(lengths)
    distinct, at, copies = np.unique(named, return_index=True, return_counts=True)
    levels, bits = build_hash(distinct)
    slots = np.zeros(len(distinct), SLOT)
    slot = Hash(levels, bits).slots(distinct)
    start = ends[at] - lengths[at]
    slots["fingerprint"][slot] = fingerprint(distinct)
    slots["copies"][slot] = copies
    slots["offset"][slot] = start
    slots["length"][slot] = ends[at + copies - 1] - start
    return {
        "place": place, "shard": shard, "first": int(named[0]), "last": int(named[-1]),
        "n_tokens": len(flat), "wide": wide,
        "payload": flat.astype("<u4" if wide else "<u2").tobytes(), "lengths": lengths.astype("<u8").tobytes(),
        "keys": named.astype("<i8").tobytes(), "levels": levels, "bits": bits, "slots": slots.tobytes(),
    }


def write_shards(
    documents: DataFrame,
    path: str,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encode all documents and write them as shards in ascending id order."""
    kinds = arrow_types(documents.sparkSession, SHARD_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place, shard = TaskContext.get().partitionId(), 0
        known = encoder(tokenizer)
        keys, ids, held = [], [], 0

        def row() -> pa.RecordBatch:
            packed = pack(place, shard, keys, ids)
            return pa.RecordBatch.from_arrays([pa.array([v], kinds[k]) for k, v in packed.items()], names=list(packed))

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = part.column(1).to_pylist()
                for key, found in zip(part.column(0).to_pylist(), known.encode(texts)):
                    if held and held + len(found) >= shard_tokens:
                        yield row()
                        keys, ids, held, shard = [], [], 0, shard + 1
                    keys.append(key)
                    ids.append(np.append(found, np.uint32(end_id)))
                    held += len(found) + 1
        if keys:
            yield row()

    rows = documents.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(NULL_KEY)).alias("key"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    ordered = rows.withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").select("key", "text")
    ordered.mapInArrow(run, SHARD_SCHEMA).write.mode("overwrite").parquet(path)


def _shard(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Payload ids, slots and distinct keys of a shard row."""
    ids = np.frombuffer(row["payload"], "<u4" if row["wide"] else "<u2")
    return ids, np.frombuffer(row["slots"], SLOT), np.unique(np.frombuffer(row["keys"], "<i8"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the shards by key.

    Each key goes through the index of its shard; the ids of its slot are cut out of the
    payload. ``start`` counts the ids of all documents before, over all shards.
    """
    schema = "doc_id long, place int, shard int, offset long, n_tokens long, ids_crc32 long"
    kinds = arrow_types(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, slots, keys = _shard(row)
                lengths = np.frombuffer(row["lengths"], "<u8").astype(np.int64)
                slot = Hash(row["levels"], row["bits"]).slots(keys)
                if (slots["fingerprint"][slot] != fingerprint(keys)).any():
                    raise ValueError(f"shard {row['place']}/{row['shard']}: a key lost its fingerprint")
                out: dict[str, list] = {name: [] for name in kinds}
                nth = 0
                for key, at in zip(keys.tolist(), slot.tolist()):
                    start = int(slots["offset"][at])
                    for n in lengths[nth : nth + int(slots["copies"][at])].tolist():
                        out["doc_id"].append(None if key == NULL_KEY else key)
                        out["offset"].append(start)
                        out["n_tokens"].append(n)
                        out["ids_crc32"].append(zlib.crc32(ids[start : start + n].astype("<u4").tobytes()))
                        start += n
                    nth += int(slots["copies"][at])
                out["place"], out["shard"] = [row["place"]] * nth, [row["shard"]] * nth
                yield pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for k, v in out.items()], names=list(out))

    shards = spark.read.parquet(path)
    found = shards.mapInArrow(run, schema)
    return found.join(shard_starts(shards), ["place", "shard"]).select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def shard_starts(shards: DataFrame) -> DataFrame:
    """(place, shard, base): ids before each shard; summed inside a place, then over places."""
    inside = Window.partitionBy("place").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy(F.lit(0)).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    places = shards.groupBy("place").agg(F.sum("n_tokens").alias("n")).select(
        "place", F.coalesce(F.sum("n").over(over), zero).alias("before")
    )
    own = shards.select("place", "shard", F.coalesce(F.sum("n_tokens").over(inside), zero).alias("within"))
    return own.join(places, "place").select("place", "shard", (F.col("before") + F.col("within")).alias("base"))


def fetch(spark: SparkSession, path: str, key: int) -> list[np.ndarray]:
    """The ids of the documents with one key: the shards of its id range, a bit test, a slot."""
    named = np.array([key], np.int64)
    found = []
    hits = spark.read.parquet(path).filter((F.col("first") <= key) & (F.col("last") >= key))
    for row in (r.asDict() for r in hits.orderBy("place", "shard").toLocalIterator()):
        at = int(Hash(row["levels"], bytes(row["bits"])).slots(named)[0])
        ids, slots, _ = _shard(row)
        if at < 0 or slots["fingerprint"][at] != fingerprint(named)[0]:
            continue
        lengths = np.frombuffer(row["lengths"], "<u8").astype(np.int64)
        start = int(slots["offset"][at])
        nth = int(np.searchsorted(np.cumsum(lengths), start, "right"))
        for n in lengths[nth : nth + int(slots["copies"][at])].tolist():
            found.append(ids[start : start + n].copy())
            start += n
    return found


def shard_folder(spark: SparkSession) -> str:
    """A new folder for shards in the shared folder of this application."""
    import uuid

    return f"{run_folder(spark)}/shards-{uuid.uuid4().hex}"
