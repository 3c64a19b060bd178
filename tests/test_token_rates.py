"""Average click rates of tokens, against a count by hand."""

import pytest

from cohortloom.operators import rates

ROWS = [
    (1, 7, 1, "x y"), (2, 7, 0, "x y"), (3, 7, 1, "x x"), (3, 7, 0, "y"), (4, 7, -1, "x z"), (5, 8, 1, "x y"),
    (6, 7, 1, None), (None, 7, 0, "x y"), (9, None, 1, "x"), (10, 7, None, "x"),
]


def by_hand():
    rows = [(u, a, c, (t or "-1").split(" ")) for u, a, c, t in ROWS if c is not None]
    shown, out = {}, {}
    for _, a, c, tokens in rows:
        for t in tokens:
            if t != "-1" and c != -1 and a is not None:
                shown.setdefault((t, a), []).append(c)
    for u, a, _, tokens in rows:
        out.setdefault((u, a), []).extend(sum(shown[t, a]) / len(shown[t, a]) for t in tokens if (t, a) in shown)
    return {k: sum(v) / len(v) if v else None for k, v in out.items()}


def samples(spark, times=1):
    rows = [r for r in ROWS for _ in range(times)]
    return spark.createDataFrame(rows, "uid long, aid long, label long, interest1 string")


def test_token_rates_by_hand(spark):
    found = {(r["uid"], r["aid"]): r["interest1ctr"] for r in rates.token_pair_rates(samples(spark), ["interest1"]).collect()}
    assert found == {k: pytest.approx(v) if v is not None else None for k, v in by_hand().items()}


def test_tokens_are_listed_once_for_a_text_and_an_ad(spark, monkeypatch):
    """What tokens are listed from grows with the texts of an ad, not with the rows."""
    written = []
    real = rates.settle
    monkeypatch.setattr(rates, "settle", lambda df: written.append(real(df)) or written[-1])
    rates.token_pair_rates(samples(spark, 5), ["interest1"]).collect()
    assert [df.count() for df in written] == [7]
