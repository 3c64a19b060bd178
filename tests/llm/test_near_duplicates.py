import random

import numpy as np

from pyspark.sql import functions as F

from cohortloom.llm import near_duplicates as nd
from cohortloom.llm.groups import components


def classes_of(rows):
    out = {}
    for r in rows:
        out.setdefault(r["class_id"], set()).add(r["doc_id"])
    return {frozenset(v) for v in out.values()}


def plain_classes(data, least):
    """Components of all pairs by exact weighted Jaccard similarity."""
    texts = [(i, t) for i, t in data]
    n = len(texts)
    counts = np.zeros(nd.BUCKETS, np.int64)
    for _, t in texts:
        counts[np.unique(nd.hashed_text(t) % np.uint64(nd.BUCKETS)).astype(np.int64)] += 1
    idf = nd.inverse(counts, n)
    vectors = [nd.weighted(t, idf) for _, t in texts]
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if nd.similarity(vectors[i], vectors[j]) >= least:
                root[find(i)] = find(j)
    out = {}
    for i in range(n):
        out.setdefault(find(i), set()).add(texts[i][0])
    return {frozenset(v) for v in out.values()}


def edited(rng, base, edits, vocabulary):
    line = list(base)
    for _ in range(edits):
        line[rng.randrange(len(line))] = rng.choice(vocabulary)
    return line


def test_against_all_pairs(documents):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(500)]
    data = []
    for family in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((12, 60, 200)))]
        for copy in range(rng.choice((1, 2, 5, 12))):
            line = edited(rng, base, copy % 4 if len(base) > 50 else copy % 2, vocabulary)
            data.append((len(data), " ".join(line)))
    data += [(900, "one two three"), (901, "One two THREE"), (902, "one two four")]
    want = plain_classes(data, 0.8)
    got = classes_of(nd.near_duplicates(documents(data), bands=40, rows=3).collect())
    assert got == want


def test_a_chain_and_a_hub(documents):
    rng = random.Random(1)
    vocabulary = [f"v{i}" for i in range(5000)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    # variants far from one another, each near the text with the largest id
    data = []
    for i in range(20):
        line = list(base)
        line[i * 6] = f"x{i}"
        line[i * 6 + 1] = f"y{i}"
        data.append((i, " ".join(line)))
    data.append((99, " ".join(base)))
    got = classes_of(nd.near_duplicates(documents(data)).collect())
    assert got == {frozenset([*range(20), 99])} == plain_classes(data, 0.8)


def test_nulls_copies_and_stage(documents):
    text = " ".join(f"a{i}" for i in range(40))
    data = [(5, text), (3, text), (3, text), (None, text), (7, None), (8, ""), (9, " \n"), (10, "other words here altogether now and then")]
    df = documents(data)
    got = nd.near_duplicates(df).collect()
    assert len(got) == len(data)
    assert {(r["doc_id"], r["class_id"], r["class_size"]) for r in got} == {
        (5, 3, 4), (3, 3, 4), (None, 3, 4), (7, 7, 1), (8, 8, 1), (9, 9, 1), (10, 10, 1)
    }
    kept = nd.one_of_each(df)
    assert kept.columns == df.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids == [10, 7, 8, 9, None] or ids == [10, 3, 7, 8, 9]
    assert nd.near_duplicates(documents([])).count() == 0
    assert nd.one_of_each(documents([])).count() == 0


def test_samples_agree_as_often_as_the_similarity():
    rng = np.random.default_rng(0)
    shingles = np.unique(rng.integers(0, 2**63, 400).astype(np.uint64))
    one, two = rng.uniform(0.5, 3, len(shingles)), rng.uniform(0.5, 3, len(shingles))
    exact = np.minimum(one, two).sum() / np.maximum(one, two).sum()
    sampler = nd.Sampler(4000, draws=1 << 12)
    a, b = sampler(shingles, one), sampler(shingles, two)
    assert abs(((a[0] == b[0]) & (a[1] == b[1])).mean() - exact) < 0.05


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(60)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        lo, hi = sorted((find(a), find(b)))
        root[hi] = lo
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def test_one_of_each_with_clashing_columns_and_equal_rows(spark, documents):
    text = " ".join(f"w{i}" for i in range(40))
    names = ["_id", "_own", "_digest", "id", "row", "tie", "kept_id", "root", "best"]
    df = documents([(1, text), (1, text), (2, text + " x"), (3, None)])
    df = df.select("*", *[F.lit(1).alias(n) for n in names]).withColumn("other", F.monotonically_increasing_id() % 2)
    kept = nd.one_of_each(df)
    assert kept.columns == df.columns
    first = sorted(map(str, kept.collect()))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]
    assert sorted(map(str, nd.one_of_each(df.repartition(5)).collect())) == first
