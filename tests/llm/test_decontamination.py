import pytest

from pyspark.sql import functions as F

from cohortloom.llm import decontamination

SCHEMA = "item_id long, text string, hash string, slots string"
ITEM = "Mr. Miller has 12 apples and gives 5 of them to Anna, then buys 3 kg of pears. How many apples has Miller now?"
OTHER = "the river runs past seven old houses and a bridge of grey stone before it meets the sea"
PLAIN = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300))


@pytest.fixture
def found(spark, documents):
    def run(docs, items, **settings):
        benchmark = spark.createDataFrame([(i, t, None, None) for i, t in items], SCHEMA)
        return {(r["doc_id"], r["item_id"]): r for r in decontamination.leaks(documents(docs), benchmark, **settings).collect()}

    return run


def test_copies_and_new_parameters(found):
    changed = ITEM.replace("Miller", "Fisher").replace("12", "90").replace("Anna", "Tom")
    twisted = ITEM.replace("has Miller now", "has Baker now")
    docs = [
        (1, f"{PLAIN} {ITEM} {PLAIN}"), (2, f"{PLAIN}. {changed}"), (3, PLAIN), (4, None), (5, ""), (6, f"{OTHER.upper()}"),
        (7, ITEM.replace(" ", "\n\t ")), (8, twisted), (None, ITEM), (9, " ".join(OTHER.split()[:5])),
    ]
    got = found(docs, [(10, ITEM), (11, OTHER), (12, None), (13, "")])
    assert got.keys() == {(1, 10), (2, 10), (6, 11), (7, 10), (None, 10)} | ({(8, 10)} & got.keys())
    assert got[1, 10]["n_changed_slots"] == 0 and got[1, 10]["n_slots"] > 0
    assert got[2, 10]["n_changed_slots"] >= 3


def test_inconsistent_slots_are_no_evidence(found):
    item = "if 7 cats eat 7 fish then how many fish do 7 cats eat in 7 days of rain"
    fair = item.replace("7", "9")
    unfair = "if 1 cats eat 2 fish then how many fish do 3 cats eat in 4 days of rain"
    got = found([(1, fair), (2, unfair)], [(1, item)], window=14)
    assert got.keys() == {(1, 1)}


def test_short_items_and_equal_items(found):
    got = found([(1, f"{PLAIN} six old blue doors {PLAIN}"), (2, PLAIN)], [(1, "six old blue doors"), (2, "six old blue doors"), (3, "two words")])
    assert got.keys() == {(1, 1), (1, 2)}


def test_placeholders_alone_match_nothing(found):
    assert found([(1, "1 2 3 4 5 6 7 8 9 10 11 12")], [(1, "9 8 7 6 5 4 3 2 1 0 5 4")]) == {}


def test_stage_and_empty_tables(spark, documents):
    benchmark = spark.createDataFrame([(1, OTHER, None, None)], SCHEMA)
    df = documents([(1, OTHER), (2, PLAIN), (None, PLAIN), (3, None), (2, PLAIN)])
    for name in ("_leaked", "leaked_id", "id", "row"):
        df = df.withColumn(name, F.lit(1))
    kept = decontamination.without_leaks(df, benchmark)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "2", "3", "None"]
    assert decontamination.leaks(documents([]), benchmark).count() == 0
    assert decontamination.leaks(df, benchmark.limit(0)).count() == 0


def test_a_small_filter_changes_nothing(found):
    docs = [(i, f"{PLAIN} {OTHER if i % 3 == 0 else ''}") for i in range(9)]
    assert found(docs, [(1, OTHER)], bloom_bits=64).keys() == found(docs, [(1, OTHER)]).keys() == {(i, 1) for i in (0, 3, 6)}


def test_short_copies_with_a_capital_after_a_line_break_or_within_a_sentence(found):
    item = "What is the capital of France?"
    docs = [(1, f"{PLAIN} Question 5\n{item}\n{PLAIN}"), (2, f"{PLAIN} they ask What is the capital of France? {PLAIN}"), (3, PLAIN)]
    assert found(docs, [(1, item)]).keys() == {(1, 1), (2, 1)}


def test_other_names_at_sentence_starts(found):
    item = "Anna has 3 red apples today. Anna buys 4 more."
    got = found([(1, f"{PLAIN}. {item.replace('Anna', 'Tom')} {PLAIN}"), (2, f"{PLAIN}. Tom has 3 red apples today. Paul buys 4 more.")], [(1, item)])
    assert got.keys() == {(1, 1)}
    assert got[1, 1]["n_changed_slots"] == 1


def test_lower_and_upper_copies_with_names(found):
    item = "On Monday Anna Miller of Berlin met Peter Baker and Tom Fisher in Paris"
    docs = [(1, f"{PLAIN} {item.lower()}"), (2, f"{PLAIN} {item.upper()} {PLAIN}"), (3, PLAIN)]
    assert found(docs, [(1, item)]).keys() == {(1, 1), (2, 1)}


def test_words_of_letters_need_no_patterns(monkeypatch):
    """Most words are letters with symbols after them: they are read without a pattern, and alike."""
    text = "Green Hills, (see 12 kg) of \"pears\".\nEvery day!"
    expected = decontamination.canonical(text)
    used = []
    real = decontamination.EDGE

    class Edge:
        def sub(self, by, word):
            used.append(word)
            return real.sub(by, word)

    monkeypatch.setattr(decontamination, "EDGE", Edge())
    monkeypatch.setattr(decontamination, "KINDS", decontamination.Kinds())
    found, hashes, views = decontamination.canonical(text)
    assert used == ["(see", "12", '"pears".']
    assert (hashes == expected[1]).all()
    names = {k: [int(x) for x in v] for k, v in views.items()}
    assert names[decontamination.NAMED_STARTS] == [3, 3, 0, 1, 2, 0, 0, 3, 0]
    assert names[decontamination.PLAIN_STARTS] == [0, 3, 0, 1, 2, 0, 0, 0, 0]
    assert [bytes(w).decode() for w in found] == text.split()


def test_runs_are_hashed_as_sums_of_powers():
    import numpy as np

    from cohortloom.llm import tokens

    hashes = np.arange(1, 30, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for size in range(1, 31):
        runs = [hashes[i : i + min(size, 29)] for i in range(max(30 - size, 1))]
        plain = [sum(int(h) * pow(int(tokens.ODD), len(r) - 1 - k, 1 << 64) for k, h in enumerate(r)) % (1 << 64) for r in runs]
        assert (tokens.windows(hashes, size) == tokens.scramble(np.array(plain, np.uint64))).all()
