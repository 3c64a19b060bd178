import random

import numpy as np
import pytest

from cohortloom.llm import repetition
from cohortloom.llm.common import words


def covered_by_windows(tokens, size):
    places = {}
    for i in range(len(tokens) - size + 1):
        places.setdefault(tuple(tokens[i : i + size]), []).append(i)
    spots = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(size)}
    return len(spots)


def naive_maximal(ids):
    """(length, occurrences) of every repeat that no longer repeat covers everywhere."""
    n, found = len(ids), set()
    for length in range(1, n):
        at = {}
        for i in range(n - length + 1):
            at.setdefault(tuple(ids[i : i + length]), []).append(i)
        for places in at.values():
            if len(places) < 2:
                continue
            left = {ids[i - 1] if i else ("start",) for i in places}
            right = {ids[i + length] if i + length < n else ("end",) for i in places}
            if len(left) > 1 and len(right) > 1:
                found.add((length, tuple(places)))
    return found


@pytest.mark.parametrize("seed", range(30))
def test_suffix_array_against_windows(seed):
    rng = random.Random(seed)
    ids = np.array([rng.randrange(rng.choice((1, 2, 4))) for _ in range(rng.randrange(0, 60))], np.int64)
    order, common = repetition.suffix_array(ids)
    depth = repetition.deepest(order, common)
    for size in (1, 2, 3, 8):
        expected = covered_by_windows(ids.tolist(), size)
        assert repetition.covered(depth, size) == expected
        assert repetition.covered(depth, size, size) == expected
    got = {
        (length, tuple(sorted(order[lo : hi + 1].tolist())))
        for length, lo, hi in repetition.maximal_repeats(ids, order, common, 2)
    }
    assert got == {(n, at) for n, at in naive_maximal(ids.tolist()) if n >= 2}


def test_verdicts(documents, rows):
    plain = " ".join(f"w{i}" for i in range(200))
    passage = " ".join(f"p{i}" for i in range(120))
    long_repeat = " ".join([passage, " ".join(f"q{i}" for i in range(600)), passage])
    texts = [plain, None, "", " \t\n", "a b", "spam " * 100, long_repeat, plain + "\nsame line\nsame line\n\n\n", plain]
    df = documents([*enumerate(texts), (None, plain), (0, plain)])
    got = {}
    for r in repetition.repetition_rules(df).collect():
        got.setdefault(r["doc_id"], r)
    assert got[0]["kept"] and not got[0]["base_failed"] and got[0]["n_words"] == 200
    for i in (1, 2, 3, 4):
        assert got[i]["base_failed"] and not got[i]["kept"]
    assert got[5]["base_failed"] and got[5]["n_repeat_words"] == 100
    assert not got[6]["base_failed"] and not got[6]["kept"] and got[6]["longest_repeat"] == 120
    assert got[7]["n_dup_lines"] == 1 and got[7]["kept"]
    assert got[None]["kept"]
    kept = repetition.without_repetition(df)
    assert kept.columns == df.columns
    assert rows(kept, "doc_id") == [(None,), (0,), (0,), (7,), (8,)]


def test_figures(documents):
    text = "a#b é ü *x*\n\tz  %\x0bq\x1cr"
    r = repetition.repetition_rules(documents([(1, text)])).first()
    assert r["n_words"] == len(words(text)) == 6
    assert r["word_chars"] == sum(len(w.decode()) for w in words(text))
    assert r["n_symbols"] == 4


def test_empty_table(documents):
    assert repetition.repetition_rules(documents([])).count() == 0
    assert repetition.without_repetition(documents([])).count() == 0


def test_very_long_text(documents):
    r = repetition.repetition_rules(documents([(1, "ab cd " * 100_000)])).first()
    assert r["n_words"] == 200_000 and r["longest_repeat"] == 199_998
