import corpus_pipeline
from cohortloom.llm import queries
from cohortloom.llm.repetition import judge
from tests.llm.test_near_duplicates import plain_classes

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [r["text"].split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "near duplicates", "decontamination", "mixture", "token ids"]

    kept = stages["quality rules"](spark, docs, SF)
    assert kept.columns == docs.columns
    good = sorted(i for i, t in text.items() if judge(t, 5, 0.3, 100)[6])
    assert sorted(r["doc_id"] for r in kept.collect()) == good

    single = stages["near duplicates"](spark, kept, SF)
    want = {min(c) for c in plain_classes([(i, text[i]) for i in good], 0.8)}
    assert {r["doc_id"] for r in single.collect()} == want and single.count() == len(want)

    clean = stages["decontamination"](spark, single, SF)

    def leaked(t):
        flat = " ".join(t.split())
        return any(" ".join(item) in flat for item in items)

    ids = {r["doc_id"] for r in clean.collect()}
    assert ids <= want and not any(leaked(text[i]) for i in ids)
    assert len(want - ids) <= sum(leaked(text[i]) for i in want) + 2

    mixed = stages["mixture"](spark, clean, SF)
    assert mixed.columns == docs.columns
    final = stages["token ids"](spark, mixed, SF)
    assert sorted(r["doc_id"] for r in final.collect()) == sorted(r["doc_id"] for r in mixed.collect())

    again = queries.QUERIES["pipeline"](spark, SF).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, final.collect()))


def test_every_operator_is_registered():
    names = list(queries.QUERIES)
    assert [n.split("_")[0] for n in names[:10]] == [f"op{i}" for i in range(1, 11)] and names[10] == "pipeline"
    assert set(queries.ORACLES) <= set(names)
