import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import collocations
from cohortloom.llm.common import Written


def counts(rows):
    """f of every phrase of up to four words, per language."""
    f = defaultdict(Counter)
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang or "und"][tuple(words[i : i + size])] += 1
    return f


def brute(rows, least=30, top=2000):
    out = []
    for lang, f in counts(rows).items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        candidates = {p: v for p, v in f.items() if len(p) > 1 and v >= least}
        kept = []
        for p, a in candidates.items():
            around = [
                v for q, v in candidates.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if any(100 * v >= 80 * a for v in around):
                continue
            score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), a, l, r, n, score))
        for rank, (_, _, phrase, a, l, r, n, score) in enumerate(sorted(kept)[:top], start=1):
            out.append((lang, rank, phrase.decode(), a, l, r, n, score))
    return sorted(out)


def make(spark, rows):
    return spark.createDataFrame(
        [(i, t, lang, "w", 1) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string, word string, n long"
    )


def texts(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "ab\x01", "\x00", "new york", "the", "the", "the", "of the", "x-y"]
    made = []
    for _ in range(n):
        words = rng.choices(vocabulary, k=rng.randrange(60))
        seps = rng.choices([" ", "  ", "\t", ". ", ", ", "\n", "!?"], weights=[30, 1, 1, 1, 1, 1, 1], k=len(words))
        made.append(("".join(w + s for w, s in zip(words, seps)), rng.choice(["en", "en", "en", None, "de"])))
    return made


@pytest.mark.parametrize("seed, least, group_leaves", [(1, 30, 1 << 19), (2, 5, 200), (3, 3, 20)])
def test_equals_brute_force(spark, rows, seed, least, group_leaves):
    made = texts(seed) + [(None, "en"), ("", "en"), ("the cat sat " * 3000, "en"), ("z" * 20000, "de"), ("a. a. a", "fr")]
    found = rows(collocations.collocations(make(spark, made), least, 2000, group_leaves))
    assert found == brute(made, least)


def test_top_keeps_ties_by_phrase(spark, rows):
    made = [(f"{a}{b} {b}{a}.", "en") for a in "abcdef" for b in "ghijkl"] * 4
    found = rows(collocations.collocations(make(spark, made), 4, 10))
    assert found == brute(made, 4, 10) and len(found) == 10


def test_hot_prefix_is_split_and_its_count_whole(spark):
    made = [(" ".join(f"hot w{i % 50} w{i % 7} w{i % 11}" for i in range(2000)), "en")]
    keep = Written(spark)
    nodes, words = collocations.phrase_counts(make(spark, made), keep, 3, 30)
    f = counts(made)["en"]
    named = {r["hash"]: bytes(r["word"]).decode() for r in words.collect()}
    found = {tuple(named[r[w]] for w in collocations.WORDS if r[w]): r["f"] for r in nodes.collect()}
    assert len(found) == nodes.count()
    assert all(found[p] == f[p] for p in found)
    assert {p for p, v in f.items() if v >= 3} <= set(found)


def test_two_words_of_one_hash_make_the_next_seed(spark, rows, monkeypatch):
    made = texts(5, 100)
    real = collocations.word_counts

    def clashing(docs, seed):
        """A seed with three hashes only stands for bad luck."""
        found = real(docs, seed)
        return found.withColumn("hash", found["hash"] % 3) if seed == 0 else found

    monkeypatch.setattr(collocations, "word_counts", clashing)
    assert rows(collocations.collocations(make(spark, made), 5)) == brute(made, 5)


def test_products_beyond_64_bits(spark, rows):
    a, l, r = 3 << 60, 5 << 60, 7 << 60
    nodes = spark.createDataFrame(
        [("en", 1, 2, 0, 0, a), ("en", 1, 0, 0, 0, l), ("en", 2, 0, 0, 0, r)], "lang string, w1 long, w2 long, w3 long, w4 long, f long"
    )
    found = collocations.scored(nodes, F.col("f") > 10).collect()
    assert [(x["l"], x["r"], x["score"]) for x in found] == [(l, r, 2_000_000 * a // (l + r))]


def test_an_empty_table(spark, rows):
    assert rows(collocations.collocations(make(spark, [("x", "en")]).limit(0))) == []


def test_open_path_over_many_batches():
    rng = np.random.default_rng(1)
    leaves = rng.integers(1, 4, (4, 300))
    leaves[3, leaves[2] == 3] = 0
    leaves = leaves[:, np.lexsort(leaves[::-1])]
    n = rng.integers(1, 9, 300)
    found = Counter()
    path = collocations.OpenPath()
    cuts = [0, 1, 2, 50, 51, 290, 300]
    for a, b in zip(cuts[:-1], cuts[1:]):
        batch = np.concatenate([np.ones((1, b - a), int), leaves[:, a:b]])
        for depth, rows, sums in path.add(np.zeros(b - a, int), batch, n[a:b]):
            for row, s in zip(rows[1 : depth + 1].T, sums):
                assert (depth, *row) not in found
                found[depth, *row] = s
    for depth, rows, sums in path.close():
        found[depth, *rows[1 : depth + 1, 0]] = sums[0]
    want = Counter()
    for row, x in zip(leaves.T, n):
        for depth in range(1, 5):
            want[depth, *row[:depth]] += x
    assert found == want
