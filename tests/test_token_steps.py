"""What token counts move, and what they give on odd keys."""

import pytest

from cohortloom.operators import encoders
from cohortloom.plans import proxies
from tests.test_lookup_steps import plan


def documents(spark):
    return spark.createDataFrame(
        [(1, "a b a", "B c"), (1, "b", None), (None, "A  a", "c"), (2, None, None), (3, "", "z")], "id long, t string, u string"
    )


COUNTS = [
    (None, "t", "", 1), (None, "t", "a", 2), (None, "u", "c", 1), (1, "t", "a", 2), (1, "t", "b", 2), (1, "u", "b", 1),
    (1, "u", "c", 1), (3, "t", "", 1), (3, "u", "z", 1),
]


def test_token_counts_move_texts_and_not_tokens(spark, rows):
    counts = encoders.token_counts(documents(spark), ["id"], ["t", "u"])
    assert rows(counts) == sorted(COUNTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))
    text = plan(encoders.token_counts(documents(spark), ["id"], ["t", "u"]))
    # a part is not put together with others, however short its texts are
    assert "REPARTITION_BY_NUM" in text
    assert text.count("Exchange ") == 1 and text.index("Exchange ") > text.index("Generate explode")


@pytest.mark.parametrize("small", [True, False])
def test_token_rows_are_the_same_on_both_paths(spark, rows, monkeypatch, small):
    df = documents(spark)
    vocabulary = encoders.fit_vocabulary(df, ["t", "u"]).filter("val <> 'z'")
    monkeypatch.setattr(encoders, "is_small", lambda table: small)
    found = encoders.token_count_rows(df, ["id"], ["t", "u"], vocabulary)
    number = {("t", ""): 0, ("t", "a"): 1, ("t", "b"): 2, ("u", "b"): 0, ("u", "c"): 1}
    wanted = [(k, f, number[f, t], float(n)) for k, f, t, n in COUNTS if (f, t) in number]
    assert rows(found) == sorted(wanted, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))
    assert ("BroadcastHashJoin" in plan(found)) or not small


def test_user_tokens_move_lines_once_by_user(spark, tmp_path):
    """Lines are not multiplied by their token columns before they are moved by user."""
    tables = {
        "lineitem": ([(1, 1, 5), (1, 1, 5), (1, 2, 5), (2, 3, None), (3, 9, 7), (4, None, None), (None, 1, 1)], "l_orderkey long, l_partkey long, l_suppkey long"),
        "orders": ([(1, 10), (2, 10), (3, None), (4, 11), (5, 12)], "o_orderkey long, o_custkey long"),
        "part": ([(1, "A b", "t", 3, "red x"), (2, "A b", None, 30, "blue"), (3, "C", "s", 4, "red x")], "p_partkey long, p_brand string, p_type string, p_size int, p_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    out = proxies.user_tokens(spark, str(tmp_path))
    moved = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in moved and "feature" not in moved
    assert moved.count("hashpartitioning(uid") == 1
    found = {r["uid"]: tuple(r[1:]) for r in out.select("uid", *proxies.USER_TOKENS).collect()}
    assert found == {
        10: ("A_b C", "1 2 3", "5", "blue red_x", "1 2 3", "s t", "3 30 4", "1 2"),
        None: ("", "9", "7", "", "9", "", "", "3"),
        11: ("", "", "", "", "", "", "", "4"),
    }
