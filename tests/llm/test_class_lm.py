import math
import random
import zlib

import numpy as np
import pytest

from cohortloom.llm import class_lm


def tokens(text):
    return (text or "").encode().lower().split() + [b" "]


def out(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2


def base_scores(data):
    counts = {}
    for doc, text in data:
        if not out(doc):
            for t in tokens(text):
                counts[t] = counts.get(t, 0) + 1
    n, v = sum(counts.values()), len(counts)
    return {
        (doc, text): (len(tokens(text)), sum(t in counts for t in tokens(text)), n, sum(math.log10((counts.get(t, 0) + 1) / (n + v + 1)) for t in tokens(text)))
        for doc, text in data
    }


def likelihood(counts, of, classes):
    member = np.eye(classes)[of]
    pairs = member.T @ counts @ member
    return class_lm._xlogx(pairs).sum() - class_lm._xlogx(pairs.sum(0)).sum() - class_lm._xlogx(pairs.sum(1)).sum()


def corpus(n=300, seed=0):
    """Two languages whose words never follow one another."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        side = rng.choice("ab")
        data.append((i, " ".join(f"{side}{int(rng.paretovariate(0.8))}{side}" for _ in range(rng.randrange(0, 40)))))
    return data


@pytest.mark.parametrize("head", [50, 1 << 18])
def test_base_and_score(documents, head):
    data = corpus() + [(1000, None), (1001, ""), (None, "a1a A1A É"), (5, "same id other text"), (1002, "x y"), (1002, "x y")]
    got = class_lm.class_scores(documents(data), symbols=50, classes=6, head=head).collect()
    assert len(got) == len(data)
    want = {}
    for (doc, text), figures in base_scores(data).items():
        want.setdefault(doc, []).append(figures)
    better = 0.0
    for r in got:
        assert r["held_out"] == out(r["doc_id"])
        known = [(w[0], w[1], w[2]) for w in want[r["doc_id"]]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) in known
        assert min(abs(r["base_score"] - w[3]) for w in want[r["doc_id"]]) < 1e-6
        if r["held_out"]:
            better += r["score"] - r["base_score"]
    assert better > 0
    scores = {(r["doc_id"], r["n_tokens"]): r["score"] for r in got}
    again = class_lm.class_scores(documents(data), symbols=50, classes=6, head=1000).collect()
    for r in again:
        assert r["score"] == pytest.approx(scores[r["doc_id"], r["n_tokens"]], abs=1e-6) or r["doc_id"] == 5


def test_transitions_are_distributions():
    rng = np.random.default_rng(1)
    counts = rng.poisson(1.0, (30, 30)).astype(np.int64)
    counts[:, 5] = 0
    counts[5] = 0
    of = class_lm.exchange(counts, 4)
    unseen = 0.1
    table = 10 ** class_lm.transitions(counts, of, 4, unseen)
    total = np.bincount(of, weights=counts.sum(0), minlength=4)
    # each class emits its words by their share, so classes weigh their whole count
    assert np.allclose((table * np.maximum(total, 1.0)).sum(1), 1 - unseen)


@pytest.mark.parametrize("seed", range(6))
def test_exchange_finds_two_languages(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros((40, 40), np.int64)
    counts[:20, :20] = rng.poisson(4, (20, 20))
    counts[20:, 20:] = rng.poisson(4, (20, 20))
    of = class_lm.exchange(counts, 3)
    assert not set(of[:20]) & set(of[20:])
    assert likelihood(counts, of, 3) > likelihood(counts, np.arange(40) % 3, 3)


def test_exchange_never_stops_short_of_a_better_move():
    counts = np.random.default_rng(3).poisson(0.7, (25, 25)).astype(np.int64)
    of = class_lm.exchange(counts, 3, turns=100)
    best = likelihood(counts, of, 3)
    for w in range(25):
        for c in range(3):
            other = of.copy()
            other[w] = c
            assert likelihood(counts, other, 3) <= best + 1e-6


def test_nothing_to_learn_from(documents):
    assert class_lm.class_scores(documents([])).count() == 0
    ids = [i for i in range(100) if out(i)][:2]
    got = class_lm.class_scores(documents([(ids[0], "a b"), (ids[1], None)])).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 for r in got)


@pytest.mark.parametrize("head", [8, 1 << 18])
def test_words_past_the_first_ones_have_classes_of_their_own(documents, head):
    """Two languages that share no word, though all words end alike: who knows a word's language halves what may follow."""
    rng = random.Random(4)
    data = [(i, " ".join(f"{rng.randrange(40)}{side}zzz" for _ in range(25))) for i, side in enumerate("ab" * 200)]
    got = class_lm.class_scores(documents(data), symbols=8, classes=4, head=head).collect()
    gain = [(r["score"] - r["base_score"]) / r["n_tokens"] for r in got if r["held_out"]]
    assert len(gain) > 20 and sum(gain) / len(gain) > 0.8 * math.log10(2)


def test_rounds_find_the_classes_of_all_words_together(documents):
    """Codes, tables of other words and words next to one another lead to the same class bigrams as a plain count."""
    data = [(i, t) for i, t in corpus(200, seed=2) if not out(i)]
    from cohortloom.llm.common import Written

    docs = documents(data)
    keep = Written(docs.sparkSession)
    counts = {}
    for _, text in data:
        for t in tokens(text):
            counts[t] = counts.get(t, 0) + 1
    by_n = sorted(counts, key=lambda t: (t != b" ", -counts[t], t))
    for size in (5, len(by_n)):
        head = by_n[:size]
        hashes = np.array([class_lm.hash_of(t) for t in head], np.uint64)
        texts = keep(class_lm.coded(docs, hashes, "doc_id", "text"))
        n = np.array([counts[t] for t in head], np.int64)
        of, rest, pairs = class_lm.cluster(texts, n, size == len(by_n), 5, 3, 0, 4, keep)
        found = dict(zip(hashes.tolist(), of.tolist()))
        for words in rest:
            found |= {r["hash"] % (1 << 64): r["cls"] for r in words.collect()}
        assert len(found) == len(by_n)
        want = np.zeros((3, 3), np.int64)
        for _, text in data:
            line = [found[class_lm.hash_of(t)] for t in [b" ", *tokens(text)]]
            np.add.at(want, (line[:-1], line[1:]), 1)
        assert (pairs == want).all()
