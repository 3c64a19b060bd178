import random
from fractions import Fraction

import pytest

from cohortloom.llm import mixing


def targets(sizes, weights=(5, 2, 1)):
    """Sources in order (null last) to their exact targets, by resharing the excess."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        rest = total - sum(3 * sizes[s] for s in full)
        if not free:
            return {s: Fraction(3 * sizes[s]) for s in names}
        level = Fraction(rest, sum(weight[s] for s in free))
        over = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not over:
            return {s: Fraction(3 * sizes[s]) if s in full else weight[s] * level for s in names}
        full |= over


@pytest.mark.parametrize("seed", range(4))
def test_against_exact_targets(documents, seed):
    rng = random.Random(seed)
    sources = ["b", "a", None, "c", "é", ""][: 2 + seed]
    data, sizes = [], {}
    for i in range(300):
        source = sources[0] if rng.random() < 0.4 else rng.choice(sources)
        n = rng.randrange(0, 30)
        data.append((i, None if n == 0 else "w " * n, source))
        sizes[source] = sizes.get(source, 0) + n
    got = mixing.mix(documents(data), bucket_rows=16).collect()
    want = targets(sizes)
    assert len(got) == 300
    taken = {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(float(want[r["source"]]), abs=1e-5)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for source, n in taken.items():
        assert abs(n - float(want[source])) <= 15
    assert sum(float(t) for t in want.values()) == pytest.approx(sum(sizes.values()))
    again = mixing.mix(documents(random.Random(1).sample(data, len(data))), bucket_rows=5).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)


def test_documents_are_repeated_with_their_columns(documents):
    data = [(1, "a b c", "x"), (2, "d", "x"), (3, "e f", "y"), (None, "g h", "y"), (4, None, "y"), (4, None, "y")]
    df = documents(data)
    copies = {}
    for r in mixing.mix(df).collect():
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + r["copies"]
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    got = {}
    for r in mixed.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {k: n for k, n in copies.items() if n}


def test_no_rows_and_no_words(documents):
    assert mixing.mix(documents([])).count() == 0
    assert mixing.mixed_documents(documents([])).count() == 0
    only = mixing.mix(documents([(1, ""), (2, None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in only] == [(0, 0.0, 0)] * 2
