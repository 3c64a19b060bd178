import random
import zlib

import numpy as np
import pytest

from cohortloom.llm import toxicity as tox


def test_gradients():
    rng = np.random.default_rng(0)
    w = tox.new_weights(rng)
    x = rng.standard_normal((5, 3, 3 * tox.HIDDEN)).astype(np.float32)
    given = {"f": x, "b": x * 0.5}
    mask = np.ones((5, 3), np.float32)
    mask[3:, 1] = 0
    label = np.array([1, 0, 1], np.float32)
    grads, to_given, _ = tox.gradients(w, given, mask, label)

    def slope(array, at, step=1e-2):
        was = array[at]
        array[at] = was + step
        up = tox.gradients(w, given, mask, label)[2]
        array[at] = was - step
        down = tox.gradients(w, given, mask, label)[2]
        array[at] = was
        return (up - down) / (2 * step)

    for name in ("hf", "hb", "attend", "pick", "out", "bias"):
        for at in list(np.ndindex(w[name].shape))[:5]:
            assert grads[name][at] == pytest.approx(slope(w[name], at), abs=2e-4)
    given["b"] = given["b"].copy()
    assert to_given["f"][2, 1, 4] == pytest.approx(slope(given["f"], (2, 1, 4)), abs=2e-4)
    assert to_given["b"][1, 0, 7] == pytest.approx(slope(given["b"], (1, 0, 7)), abs=2e-4)


def test_windows_overlap_and_cover():
    for n in (0, 1, 11, 12, 13, 24, 25, 36, 37, 100):
        cut = tox.cut_windows(np.arange(n))
        seen = np.bincount(cut[cut >= 0], minlength=n)
        assert (seen >= 1).all() and len(cut) == len(tox.window_starts(n))
        if n > 60:
            assert (seen[12 : n - 24] == 2).all()


def test_runs_stay_inside_words():
    together, start = tox.runs_of([b"ab", b"", b"cdef", b"x"])
    for i, word in enumerate([b"ab", b"", b"cdef", b"x"]):
        assert sorted(together[start[i] : start[i + 1]]) == sorted(tox.runs_of([word])[0])
    assert len(tox.runs_of([b"cdef"])[0]) == 4 + 3 + 2


def talk(rng, toxic):
    line = ["".join(rng.choice(("ba", "no", "ti", "rel", "um", "es")) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 90))]
    if toxic:
        for _ in range(rng.randrange(2, 5)):
            line.insert(rng.randrange(len(line) + 1), rng.choice(("vilhound", "graxx")) + rng.choice(("", "es", "um")))
    return " ".join(line)


def test_held_out_documents(spark, documents):
    rng = random.Random(3)
    truth = {i: int(rng.random() < 0.25) for i in range(900)}
    data = [(i, talk(rng, t)) for i, t in truth.items()]
    data += [(2000, None), (2001, ""), (2002, "fine " * 70_000 + "graxxes vilhound graxx"), (2003, "fine " * 3000), (None, "graxx vilhoundes")]
    labels = spark.createDataFrame([(i, 0, t, "x") for i, t in truth.items()] + [(5, 0, None, "x"), (None, 0, 1, "x")], "doc_id long, quality int, toxic int, text string")
    got = {r["doc_id"]: r for r in tox.toxicity(documents(data), labels).collect()}
    assert len(got) == len(data)
    right = [got[i]["predicted"] == t for i, t in truth.items() if got[i]["held_out"]]
    assert sum(right) / len(right) > 0.97
    for i, r in got.items():
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0)
    assert got[2002]["predicted"] == 1 and got[2003]["predicted"] == 0
    assert got[2000]["score"] == got[2001]["score"] and got[None]["predicted"] == 1


def test_missing_labels(spark, documents):
    labels = spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int")
    got = tox.toxicity(documents([(1, "a"), (2, None)]), labels).collect()
    assert len(got) == 2 and len({r["score"] for r in got}) == 1
    assert tox.toxicity(documents([]), labels.limit(0)).count() == 0


def test_long_words_are_read_to_their_end():
    weights = tox.new_weights(np.random.default_rng(1))
    weights["word"][:] = 0
    long = "_".join(f"part{i}" for i in range(40))
    scores = tox.Scorer(weights).scores([f"{long}_awful", f"{long}_lemon", "\u8a00" * 300 + "\u60aa", "\u8a00" * 300])
    assert scores[0] != scores[1] and scores[2] != scores[3]
    word = long.encode()
    cut = tox.pieces([b"a", word, b"b"])
    assert cut[0] == b"a" and cut[-1] == b"b" and max(map(len, cut)) <= 64
    assert {word[i : i + 5] for i in range(len(word) - 4)} <= {p[i : i + 5] for p in cut for i in range(len(p) - 4)}
