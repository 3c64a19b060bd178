"""Quality rules: repeated substrings of a text by its suffix array.

A suffix array over the words of one text is built by prefix doubling, and the common
prefixes of neighbouring suffixes come from the ranks of the doubling rounds. Each
interval of suffixes with a common prefix is a repeated substring; the union of the
occurrences of all of ``min_repeat`` words or more is the covered part. A text is rejected
if that part or the longest repeat is too large. Work stays within a document, so the job
has no shuffle and a task holds one Arrow batch.

Null and empty texts have no words and fail the base rules (too short). Repeated rows get
equal verdicts; other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortloom.llm.common import BLANKS, map_rows, words

MIN_REPEAT = 5
MAX_COVERED = 0.3
MAX_LONGEST = 100
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
    " n_repeat_words long, base_failed boolean, kept boolean, covered_words long,"
    " longest_repeat long, n_maximal_repeats long"
)


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of a sequence and the common prefix of each suffix with the one before."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64) + 1
    levels, step = [], 1
    while n and rank.max() < n:
        levels.append(np.append(rank, 0))
        after = np.zeros(n, np.int64)
        after[: max(0, n - step)] = rank[step:]
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64) + 1
        step *= 2
    order = np.empty(n, np.int64)
    order[rank - 1] = np.arange(n)
    common = np.zeros(n, np.int64)
    if n > 1:
        length = np.zeros(n - 1, np.int64)
        for level in range(len(levels) - 1, -1, -1):
            a, b = order[:-1] + length, order[1:] + length
            same = levels[level][np.minimum(a, n)] == levels[level][np.minimum(b, n)]
            length += same.astype(np.int64) << level
        common[1:] = length
    return order, common


def deepest(order: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For each position the length of the deepest interval that holds its suffix."""
    at = np.zeros(len(order), np.int64)
    at[order] = np.maximum(common, np.append(common[1:], 0))
    return at


def covered(depth: np.ndarray, least: int, fixed: int | None = None) -> int:
    """Words in the union of the repeats of ``least`` words or more (or of their first ``fixed``)."""
    at = np.flatnonzero(depth >= least)
    if not len(at):
        return 0
    edges = np.zeros(len(depth) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + (depth[at] if fixed is None else fixed), -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def maximal_repeats(
    ids: np.ndarray, order: np.ndarray, common: np.ndarray, least: int
) -> list[tuple[int, int, int]]:
    """(length, first, last place in the suffix array) of each maximal repeated substring.

    An interval cannot be made longer to the right. It is left out if the word before is
    the same at all its occurrences, as a longer repeat then covers it.
    """
    if not (common >= least).any():
        return []
    before = np.where(order > 0, ids[order - 1], -1 - np.arange(len(order)))
    changes = np.append(0, np.cumsum(before[1:] != before[:-1]))
    found: list[tuple[int, int, int]] = []
    starts = np.flatnonzero((common >= least) & (np.append(0, common[:-1]) < least))
    for start in starts.tolist():
        stack: list[tuple[int, int]] = []
        place = start
        while True:
            length = int(common[place]) if place < len(common) and common[place] >= least else 0
            left = place - 1
            while stack and stack[-1][0] > length:
                deep, left = stack.pop()
                if changes[place - 1] > changes[left]:
                    found.append((deep, left, place - 1))
            if not length:
                break
            if not stack or stack[-1][0] < length:
                stack.append((length, left))
            place += 1
    return found


def judge(text: str | None, min_repeat: int, max_covered: float, max_longest: int) -> tuple:
    """The columns of ``SCHEMA`` but for the id."""
    text = text or ""
    tokens = words(text)
    n = len(tokens)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in tokens), np.int64, n)
    order, common = suffix_array(ids)
    depth = deepest(order, common)
    seen: set[str] = set()
    doubles = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            doubles += line in seen
            seen.add(line)
    repeated = covered(depth, WINDOW, WINDOW)
    failed = n < MIN_WORDS or 100 * repeated > 30 * n
    union = covered(depth, min_repeat)
    longest = int(depth.max()) if n else 0
    kept = not failed and union <= max_covered * n and longest <= max_longest
    return (
        n, len(text) - len(BLANKS.findall(text)), sum(text.count(c) for c in SYMBOLS), doubles,
        repeated, failed, kept, union, longest, len(maximal_repeats(ids, order, common, min_repeat)),
    )


def repetition_rules(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_repeat: int = MIN_REPEAT,
    max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST,
) -> DataFrame:
    """One row per document: base figures, covered words, longest repeat and verdict."""
    names = [part.split()[0] for part in SCHEMA.split(",")]

    def rows(batch: pa.RecordBatch) -> dict[str, list]:
        found = [judge(t, min_repeat, max_covered, max_longest) for t in batch.column(1).to_pylist()]
        columns = list(zip(*found)) or [()] * (len(names) - 1)
        return {"doc_id": batch.column(0), **dict(zip(names[1:], columns))}

    slim = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return map_rows(slim, SCHEMA, rows)


def without_repetition(documents: DataFrame, **limits: float) -> DataFrame:
    """The documents that pass, all columns kept; texts are judged where they are read."""
    names = documents.columns
    kinds = documents.schema
    limit = {"min_repeat": MIN_REPEAT, "max_covered": MAX_COVERED, "max_longest": MAX_LONGEST} | limits

    def run(batches):
        for batch in batches:
            verdict = [judge(t, **limit)[6] for t in batch.column(names.index("text")).to_pylist()]
            yield batch.filter(pa.array(verdict, pa.bool_()))

    return documents.mapInArrow(run, kinds)
