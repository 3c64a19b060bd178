"""Benchmark decontamination by template windows and slot consistency.

Words lose the punctuation around them and are put in lower case; numbers (with a unit
written on), units after a number and names (capitalised words) become typed placeholders,
whose own values are kept as slots. A capitalised word that starts a sentence or a line may
be a name or not, so a text is read in three views: such words as plain words, such words as
names, and all words as plain words (a copy, whatever its case). Every window of
``window`` words of an item is hashed, and the windows of the documents are joined with
them on that hash. Matches of one document, item and pair of views that lie on one diagonal must fill
the slots consistently: one value of the item always meets one value of the document, so
a question with other numbers or names is caught and a chance mix is not.

A document is a leak of an item if consistent windows cover at least ``least`` of the
item's words. Windows with placeholders and fewer than ``literals`` plain words are no
evidence and are not made. Before the join, documents' windows pass a Bloom filter of the items' hashes, whose
size is a parameter and does not grow; it only saves rows, the join decides. Items with
fewer words than a window are matched as one window of all their words, items with fewer
than three words never. Null and empty texts match nothing; equal items match separately.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cohortloom.llm.bloom import BLOOM_BITS, Bloom, hit
from cohortloom.llm.common import Written, arrow_types
from cohortloom.llm.tokens import CACHE, scramble, windows

WINDOW = 8
SHORTEST = 3
LITERALS = 0.5
LEAST = 0.5

# Unit words that may follow a number.
UNITS = frozenset(
    "mm cm m km in inch inches ft feet foot yd yard yards mile miles mg g kg gram grams kilograms lb lbs pound pounds"
    " oz ounce ounces ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes"
    " h hr hour hours day days week weeks month months year years percent dollars dollar euros euro cents"
    " kmh mph km/h m/s degrees degree".split()
)
UNITS_UTF8 = frozenset(unit.encode() for unit in UNITS)
# Ends of sentences, and what may close after them.
ENDINGS, CLOSING = (".", "!", "?", ":", ";"), "\"')]}"
NUMBER = re.compile(r"[$€£]?[+-]?\d[\d.,:/]*(%|[a-zµ°/]{0,4})?", re.IGNORECASE)
# What ``EDGE`` strips at the end, of the symbols in ASCII.
SYMBOLS = "".join(c for c in string.punctuation if c not in "%_")
SYMBOLS_UTF8, CLOSING_UTF8 = SYMBOLS.encode(), CLOSING.encode()
EDGE = re.compile(r"^[^\w$€£+\-]+|[^\w%]+$")
LITERAL, NUM, UNIT, TITLE = 0, 1, 2, 3
PLACEHOLDER = {NUM: "<num>", UNIT: "<unit>", TITLE: "<name>"}


# The last three bits of a word's number: its kind, and whether it ends a sentence.
CODE, ENDS = 7, 4


class Kinds(dict):
    """Word (UTF-8) to its hash with the code in the last bits; the memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        core: bytes | str = word.rstrip(SYMBOLS_UTF8)
        kind, ends = LITERAL, False
        if core.isalpha():  # letters in ASCII: nothing more to strip, and no digit
            lower = core.lower()
            if lower in UNITS_UTF8:
                kind = UNIT
            elif len(core) > 1 and core.istitle():
                kind = TITLE
            if core != word:
                ends = word[len(core):].rstrip(CLOSING_UTF8)[-1:].decode() in ENDINGS
        else:
            text = word.decode("utf-8", "surrogatepass")
            core = text.rstrip(SYMBOLS)
            if not core.isalpha():
                core = EDGE.sub("", text)
            lower = core.lower()
            if NUMBER.fullmatch(core):
                kind = NUM
            elif lower in UNITS:
                kind = UNIT
            elif len(core) > 1 and core[0].isupper() and core[1:].islower():
                kind = TITLE
            ends = text.rstrip(CLOSING + "»”’")[-1:] in ENDINGS
        value = self[word] = xxhash.xxh3_64_intdigest(lower) & ~CODE | kind | ENDS * ends
        return value


KINDS = Kinds()
LINE = re.compile(rb"[\n\x0B\x0C\r]")
# Views of a text, and which view of an item meets which of a document.
COPY, PLAIN_STARTS, NAMED_STARTS = 1, 2, 4
MEETINGS = ((COPY, COPY), *((i, d) for i in (PLAIN_STARTS, NAMED_STARTS) for d in (PLAIN_STARTS, NAMED_STARTS)))


def canonical(text: str | None) -> tuple[list[bytes], np.ndarray, dict[int, np.ndarray]]:
    """Words of a text as UTF-8, their hashes as plain words, and their kinds in the views with placeholders."""
    found: list[bytes] = []
    first = []
    for line in LINE.split((text or "").encode("utf-8", "surrogatepass")):
        first.append(len(found))
        found += line.split()
    n = len(found)
    numbers = np.fromiter(map(KINDS.__getitem__, found), np.uint64, n)
    codes = (numbers & np.uint64(CODE)).astype(np.int8)
    hashes, kinds, ends = numbers & ~np.uint64(CODE), codes & np.int8(CODE - ENDS), codes >= ENDS
    starts = np.append(True, ends[:-1]) if n else ends
    starts[[i for i in first if i < n]] = True
    after_number = np.append(False, kinds[:-1] == NUM) if n else ends
    named = np.where((kinds == UNIT) & ~after_number, LITERAL, kinds)
    return found, hashes, {PLAIN_STARTS: np.where((named == TITLE) & starts, LITERAL, named), NAMED_STARTS: named}


def template_windows(
    hashes: np.ndarray, views: dict[int, np.ndarray], size: int, literals: float
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Places, hashes, views and kinds of the different windows with enough plain words."""
    if len(hashes) < size:
        return []

    def inside(marks: np.ndarray) -> np.ndarray:
        total = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(marks, out=total[1:])
        return total[size:] - total[:-size]

    def values(kinds: np.ndarray) -> np.ndarray:
        held = hashes.copy()
        for kind in PLACEHOLDER:
            held[kinds == kind] = kind
        return scramble(windows(held, size) + np.uint64(size))

    held = {view: inside(kinds != LITERAL) for view, kinds in views.items()}
    same = inside(views[PLAIN_STARTS] != views[NAMED_STARTS]) == 0
    places = np.arange(len(hashes) - size + 1)
    copies = COPY + sum(view * (n == 0) for view, n in held.items())
    out = [(places, scramble(windows(hashes, size) + np.uint64(size)), copies, np.zeros_like(views[PLAIN_STARTS]))]
    for view, n in held.items():
        wanted = (n > 0) & (size - n >= literals * size)
        if view == NAMED_STARTS:
            wanted &= ~same
        at = np.flatnonzero(wanted)
        if len(at):
            seen = np.where(same[at], PLAIN_STARTS + NAMED_STARTS, view)
            out.append((at, values(views[view])[at], seen, views[view]))
    return out


def slots(found: list[bytes], kinds: np.ndarray, at: int, size: int) -> list[str]:
    texts = [found[i].decode("utf-8", "surrogatepass") for i in range(at, at + size) if kinds[i] != LITERAL]
    return [EDGE.sub("", text).lower() for text in texts]


WINDOWS = "id long, n_words long, place long, hash long, views int, slots array<string>"


def window_rows(
    rows: DataFrame, sizes: list[int], literals: float, whole_if_short: bool, bloom: Bloom | None
) -> DataFrame:
    """Template windows of (id, text); of the short items one window of all their words."""
    kinds = arrow_types(rows.sparkSession, WINDOWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bloom.bits() if bloom else None
        for batch in batches:
            out: dict[str, list] = {name: [] for name in kinds}
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found, hashes, views = canonical(text)
                own = [min(sizes[0], len(found))] if whole_if_short else sizes
                for size in (s for s in own if s >= SHORTEST):
                    for at, values, seen_in, kind in template_windows(hashes, views, size, literals):
                        if bits is not None:
                            seen = hit(bits, values)
                            at, values, seen_in = at[seen], values[seen], seen_in[seen]
                        out["id"] += [key] * len(at)
                        out["n_words"] += [len(found)] * len(at)
                        out["place"] += at.tolist()
                        out["hash"] += values.view(np.int64).tolist()
                        out["views"] += seen_in.tolist()
                        out["slots"] += [slots(found, kind, i, size) for i in at.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for k, v in out.items()], names=list(out))

    return rows.mapInArrow(run, WINDOWS)


def leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    literals: float = LITERALS,
    least: float = LEAST,
    bloom_bits: int = BLOOM_BITS,
) -> DataFrame:
    """(doc_id, item_id, covered_words, item_words, n_slots, n_changed_slots), one row per leak.

    ``n_changed_slots`` counts the placeholders of the item that have another value in the
    document: 0 for a copy, more for a question asked with other numbers or names.
    """
    keep = Written(documents.sparkSession)
    items = benchmark.select(F.col(item_column).cast("long").alias("id"), F.col(item_text_column).alias("text"))
    texts = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    wanted = keep(window_rows(items.repartition("id"), [window], literals, True, None))
    short = wanted.filter(F.col("n_words") < window).select("n_words").distinct()  # below ``window`` rows
    sizes = [window, *sorted(r["n_words"] for r in short.collect())]
    found = window_rows(texts, sizes, literals, False, Bloom(wanted, "hash", bloom_bits))

    of_documents = found.select(
        F.col("id").alias("doc_id"), F.col("place").alias("doc_place"), "hash", F.col("views").alias("doc_views"), F.col("slots").alias("doc_slots")
    )
    of_items = wanted.select(
        F.col("id").alias("item_id"), "n_words", "place", "hash", F.col("views").alias("item_views"), F.col("slots").alias("item_slots")
    )
    both = F.array(*[F.struct(F.lit(i).alias("item"), F.lit(d).alias("doc")) for i, d in MEETINGS])
    met = F.filter(
        both, lambda m: (F.col("item_views").bitwiseAND(m["item"]) > 0) & (F.col("doc_views").bitwiseAND(m["doc"]) > 0)
    )
    pairs = of_documents.join(of_items, "hash").withColumn("met", F.explode(met))
    filled = F.arrays_zip("item_slots", "doc_slots")
    lines = pairs.groupBy("doc_id", "item_id", "n_words", "met", (F.col("doc_place") - F.col("place")).alias("shift")).agg(
        F.collect_set("place").alias("places"), F.array_distinct(F.flatten(F.collect_set(filled))).alias("filled")
    )
    values = F.array_distinct(F.transform("filled", lambda s: s["item_slots"]))
    consistent = lines.filter(F.size(values) == F.size("filled"))
    size = F.least(F.lit(window), F.col("n_words"))
    spots = F.flatten(F.transform("places", lambda p: F.sequence(p, p + size - 1)))
    by_item = consistent.withColumn("spots", spots).groupBy("doc_id", "item_id", "n_words").agg(
        F.array_distinct(F.flatten(F.collect_list("spots"))).alias("spots"),
        F.array_distinct(F.flatten(F.collect_list("filled"))).alias("filled"),
    )
    changed = F.filter("filled", lambda s: s["item_slots"] != s["doc_slots"])
    return by_item.filter(F.size("spots") >= least * F.col("n_words")).select(
        "doc_id", "item_id",
        F.size("spots").cast("long").alias("covered_words"),
        F.col("n_words").alias("item_words"),
        F.size("filled").cast("long").alias("n_slots"),
        F.size(changed).cast("long").alias("n_changed_slots"),
    )


def without_leaks(documents: DataFrame, benchmark: DataFrame, **settings: float) -> DataFrame:
    """The documents without a leak, all columns kept."""
    found = leaks(documents, benchmark, **settings).select(F.col("doc_id").alias("leaked_id")).distinct()
    # a row travels as one struct: no column of the table can clash
    rows = documents.select(
        F.struct(*[F.col(f"`{n}`") for n in documents.columns]).alias("row"), F.col("doc_id").cast("long").alias("id")
    )
    return rows.join(found, F.col("id") == F.col("leaked_id"), "left_anti").select("row.*")
