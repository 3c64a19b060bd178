import random

import pytest
from pyspark.sql import functions as F

from cohortloom.llm import lines


def plain_removed(data, similar=0.8):
    """Lines with an earlier line of Jaccard similarity ``similar`` or more, by comparing all pairs."""
    placed = []
    for doc, text in data:
        for number, line in enumerate((text or "").split("\n")):
            found = frozenset(line.encode().split())
            if found:
                placed.append((doc, number, found))
    placed.sort(key=lambda p: p[:2])
    out = {}
    for i, (doc, number, found) in enumerate(placed):
        if any(5 * len(found & p[2]) >= 4 * len(found | p[2]) for p in placed[:i]):
            out.setdefault(doc, []).append(number)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_against_all_pairs(documents, seed):
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(30 + 200 * (seed % 2))]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice((1, 3, 4, 5, 7, 8, 9, 10, 12, 20, 40)))] for _ in range(25)]
    data = []
    for doc in range(40):
        text = []
        for _ in range(rng.randrange(0, 6)):
            line = list(rng.choice(bases))
            for _ in range(rng.choice((0, 0, 1, 1, 2, 4))):
                if rng.random() < 0.5 and len(line) > 1:
                    line.pop(rng.randrange(len(line)))
                else:
                    line.insert(rng.randrange(len(line) + 1), rng.choice(vocabulary))
            text.append(" ".join(line))
        data.append((doc, "\n".join(text)))
    got = {r["doc_id"]: r for r in lines.dedup_lines(documents(data), buckets=64 if seed == 3 else lines.BUCKETS).collect()}
    want = plain_removed(data)
    assert {k: r["removed"] for k, r in got.items() if r["removed"]} == want
    for doc, text in data:
        assert got[doc]["text"] == "\n".join(x for i, x in enumerate(text.split("\n")) if i not in want.get(doc, []))


def test_nulls_blank_lines_and_repeats(documents):
    data = [(2, "a b c\n\n \na b c"), (None, "a b c"), (3, None), (4, ""), (5, "c b a\r\nx"), (6, "x\ty"), (6, "x\ty")]
    got = lines.dedup_lines(documents(data)).collect()
    assert len(got) == len(data)
    found = {(r["doc_id"], tuple(r["removed"])) for r in got}
    # a row without an id comes first; equal rows stand for one another
    assert found == {(2, (0, 3)), (None, ()), (3, ()), (4, ()), (5, (0,)), (6, ())}
    assert [r["text"] for r in got if r["doc_id"] == 3] == [None]
    assert lines.dedup_lines(documents([])).count() == 0


def test_a_family_of_lines_is_not_compared_pair_by_pair(documents):
    base = [f"w{i}" for i in range(50)]
    data = [(0, " ".join(base))] + [(i, " ".join(base[: i % 50] + [f"new{i}"] + base[i % 50 + 1 :])) for i in range(1, 301)]
    classes, matched = lines.similar_lines(documents(data))
    assert classes.count() == 301 and matched.count() == 300
    assert matched.agg(F.sum("n_links")).first()[0] < 1000
