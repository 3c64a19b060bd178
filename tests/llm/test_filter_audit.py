from itertools import permutations

import numpy as np
import pytest

from cohortloom.llm import filter_audit

LONG = " ".join(f"w{i}" for i in range(60))


def brute(rows, labels):
    """Apply the filters one after the other to every document, in every order."""
    docs = []
    for doc_id, text, source in rows:
        words = (text or "").split()
        same = [d for d, t, _ in rows if (t or "") == (text or "") and d is not None]
        docs.append((source or "", doc_id, [
            len(words) < 50, 100 * len(set(words)) < 65 * len(words),
            100 * sum("A" <= c <= "Z" for c in text or "") > 5 * len(text or ""),
            any(c in "#$%&*|" for c in text or ""),
            doc_id is not None and any(d < doc_id for d in same),
        ]))
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    out = {}
    for part in {p for p, _, _ in docs}:
        mine = [d for d in docs if d[0] == part]
        totals = np.zeros(5, int)
        for order in permutations(range(5)):
            left = list(mine)
            for step, f in enumerate(order, start=1):
                gone = [d for d in left if d[2][f]]
                before = [d for d in mine if d not in left]
                left = [d for d in left if not d[2][f]]
                totals[f] += len(gone)
                out[part, "".join("ABCDE"[x] for x in order), step] = [
                    len(left), len(gone), sum(d[2][f] for d in before),
                    sum(d[2][f] and sum(d[2]) == 1 for d in mine),
                    sum(d[1] in good for d in gone), sum(d[1] in toxic for d in gone), f,
                ]
        for key, row in out.items():
            if key[0] == part:
                row[6] = int(totals[row[6]])
    return out


def result(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r["part"], r["filter_order"], r["step"]): [r[n] for n in names] for r in df.collect()}


def test_equals_filtering_step_by_step(spark, documents):
    texts = [None, "", "short", LONG, LONG, LONG.upper(), LONG + " #", "a b " * 40, "A " * 60, "$ x", "x" * 5000]
    rows = [(i, texts[i * 7 % len(texts)], ["s", None, "", "t"][i % 4]) for i in range(60)]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 60, 2)] + [(4, None, None), (6, 0, 0), (6, 1, 0), (None, 1, 1)]
    table = spark.createDataFrame([(d, q, int(t) if t is not None else None) for d, q, t in labels], "doc_id long, quality int, toxic int")
    # a clashing column of the documents is not read
    df = documents([(d, t, s) for d, t, s in rows])
    found = result(filter_audit.audit(df, table))
    assert found == brute(rows, labels)
    assert len(found) == 3 * 120 * 5


def test_ids_that_repeat_or_are_missing(spark, documents):
    rows = [(1, LONG, "s"), (1, LONG, "s"), (2, LONG, "s"), (None, LONG, "s"), (None, "x", "s")]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = result(filter_audit.audit(documents(rows), labels))
    # the two rows of doc_id 1 are no copies of each other, the nameless ones of none
    assert found["s", "EABCD", 1][:2] == [4, 1]


def test_without_documents(spark, documents):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(documents([(1, "x")]).limit(0), labels).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_min_plus_is_the_first_failed_filter(n):
    orders, places = filter_audit.positions(n)
    masks = np.arange(1 << n)
    removal = filter_audit.min_plus(places, masks)
    for o, order in enumerate(orders):
        for m in masks:
            first = [s for s, f in enumerate(order, start=1) if m >> f & 1]
            assert removal[o, m] == (first[0] if first else n + 1)
