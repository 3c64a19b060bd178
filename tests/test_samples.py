import math
import random

import numpy as np
import pytest
from pyspark.sql.types import StructType
from pyspark.sql import functions as F

from cohortloom.functions import dominance, joins, ordering, scalars, splitting
from cohortloom.functions.tokens import replace_tokens, shared_tokens, token_count
from cohortloom.operators import encoders, metrics, rates, screening, sketches, tokens
from cohortloom.operators.windows import DayWindow
from cohortloom.session import shared_folder
from cohortloom.sources import readers, schemas, writers


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "x string").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize("text, n", [("-1", -1), ("7", 1), ("7 9", 2), ("7  9", 3)])
def test_token_count(spark, text, n):
    assert one(spark, text, token_count) == n


def test_replaced_are_whole_tokens_and_all_copies(spark):
    assert one(spark, "7 9 9", lambda c: replace_tokens(c, ["9"])) == "7 other other"
    assert one(spark, "-1", lambda c: replace_tokens(c, ["1"])) == "-1"
    assert one(spark, "a b a", lambda c: F.array_join(shared_tokens(c, ["a", "z"]), " ")) == "a"


@pytest.mark.parametrize("literal", [100, 0])
@pytest.mark.parametrize("broadcast", [100, 0])
def test_collapse_rare_both_ways(spark, rows, literal, broadcast):
    df = spark.createDataFrame([(1, "7 9 9", "a"), (2, "-1", "b a"), (3, "7  9", None)], "k long, x string, y string")
    rare = spark.createDataFrame([("x", "9"), ("y", "b")], "feature string, token string")
    out = tokens.collapse_rare(df, ["k"], rare, ["x", "y"], literal, broadcast)
    assert rows(out) == [(1, "7 other other", "a"), (2, "-1", "other a"), (3, "7  other", None)]


@pytest.mark.parametrize("literal", [100, 1, 0])
@pytest.mark.parametrize("broadcast", [100, 0])
def test_collapse_rare_keeps_every_row(spark, rows, literal, broadcast):
    df = spark.createDataFrame(
        [(1, "a b", None), (2, None, None), (3, "c", "b"), (1, "c d", "b b"), (1, "a b", None), (None, "b", "a")],
        "k long, x string, y string",
    )
    rare = spark.createDataFrame([("x", "b"), ("x", "d"), ("y", "b")], "feature string, token string")
    out = tokens.collapse_rare(df, ["k"], rare, ["x", "y"], literal, broadcast)
    assert rows(out) == [
        (None, "other", "a"), (1, "a other", None), (1, "a other", None), (1, "c other", "other other"), (2, None, None),
        (3, "c", "other"),
    ]


def test_rank_and_cut(spark, rows):
    table = spark.createDataFrame(
        [("f", "a", 3.0), ("f", "b", 5.0), ("f", "c", 3.0), ("f", "-1", 99.0), ("g", "z", 1.0)],
        "feature string, token string, importance double",
    )
    ranked = tokens.rank_tokens(table)
    assert rows(ranked, "feature", "token", "position") == [("f", "a", 2), ("f", "b", 1), ("f", "c", 3), ("g", "z", 1)]
    assert rows(tokens.rare_tokens(ranked, {"f": 1}), "token") == [("a",), ("c",)]
    assert rows(tokens.nth_token(ranked, {"f": 1}), "token") == [("a",)]
    assert rows(tokens.rare_tokens(ranked, {"f": 50}), "token") == []


@pytest.mark.parametrize("parts", [1, 5])
def test_running_totals_equal_brute_force(spark, parts):
    rnd = random.Random(3)
    data = sorted({(rnd.choice("ab"), rnd.randrange(500)) for _ in range(300)})
    values = [(g, x, rnd.randrange(5)) for g, x in data]
    df = spark.createDataFrame(values, "g string, x long, n long").repartition(parts)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r["g"], r["x"]): (r["n_upto"], r["n_all"]) for r in ordering.running_totals(df, ["g"], ["x"], ["n"], ["x"]).collect()}
        ranks = {(r["g"], r["x"]): r["position"] for r in ordering.positions(df, ["g"], ["x"]).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    for g, x, _ in values:
        mine = [v for v in values if v[0] == g]
        assert got[(g, x)] == (sum(v[2] for v in mine if v[1] >= x), sum(v[2] for v in mine))
        assert ranks[(g, x)] == sum(v[1] <= x for v in mine)


def test_running_totals_without_groups(spark):
    df = spark.createDataFrame([(i, 1) for i in range(50)], "x long, n long")
    assert sorted(r["n_upto"] for r in ordering.running_totals(df, [], ["x"], ["n"]).collect()) == list(range(1, 51))


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "label int, score double")


def test_auc(spark):
    assert metrics.roc_auc(scored(spark, [(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)])).first()["auc"] == 0.75
    assert metrics.roc_auc(scored(spark, [(0, 0.5), (1, 0.5), (1, 0.5)])).first()["auc"] == 0.5
    assert metrics.roc_auc(scored(spark, [(1, 0.5), (1, 0.6)])).first()["auc"] is None


def test_auc_equals_pairs_under_ties(spark):
    rnd = random.Random(5)
    pairs = [(rnd.randrange(2), rnd.randrange(6) / 10) for _ in range(200)]
    pos, neg = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    df = scored(spark, pairs)
    for parts in (1, 6):
        assert metrics.roc_auc(df.repartition(parts)).first()["auc"] == pytest.approx(won / len(pos) / len(neg))


def test_best_f1(spark):
    rnd = random.Random(6)
    pairs = [(rnd.randrange(2), rnd.randrange(8) / 10) for _ in range(150)]
    total = sum(y for y, _ in pairs)
    scores = sorted({s for _, s in pairs})

    def f1(t):
        tp = sum(y for y, s in pairs if s >= t)
        return 2 * tp / (sum(s >= t for _, s in pairs) + total)

    row = metrics.best_f1(scored(spark, pairs)).first()
    assert row["f1"] == pytest.approx(max(map(f1, scores)))
    assert row["threshold"] == min(t for t in scores if f1(t) == max(map(f1, scores)))
    assert metrics.best_f1(scored(spark, [(0, 0.1), (0, 0.2)])).first()["f1"] == 0.0


def test_codes_sort_numbers_as_numbers(spark, rows):
    df = spark.createDataFrame([("10", "b"), ("9", "a"), ("-1", "10"), ("09", "9")], "n string, t string")
    codes = encoders.fit_codes(df, ["n", "t"])
    assert rows(codes.filter("feature = 'n'"), "val", "index") == [("-1", 0), ("09", 1), ("10", 2), ("9", 1)]
    assert rows(codes.filter("feature = 't'"), "val", "index") == [("10", 0), ("9", 1), ("a", 2), ("b", 3)]
    coded = encoders.encode(df, codes, ["n"])
    assert rows(coded, "n", "n_code") == [("-1", 0), ("09", 1), ("10", 2), ("9", 1)]


def test_crosses_are_pairs_once(spark):
    df = spark.createDataFrame([(1, "x", "y", "z")], "k long, a string, b string, c string")
    out = encoders.cross_pairs(df, ["k"], ["a", "b", "c"])
    assert out.columns == ["k", "aXb", "aXc", "bXc"]
    assert tuple(out.first()) == (1, "x y", "x z", "y z")


def test_double_lookup_keys_are_refused(spark):
    left = spark.createDataFrame([(1,)], "k long")
    table = spark.createDataFrame([(1, 2), (1, 3)], "k long, v long")
    with pytest.raises(ValueError):
        joins.lookup(left, table, ["k"])
    long = spark.createDataFrame([("f", 1, 2.0), ("f", 1, 3.0)], "feature string, at long, v double")
    with pytest.raises(ValueError):
        joins.lookup_all(left, long, {"f": ["k"]}, ["at"], "v", "_v")


@pytest.mark.parametrize("limit", [1000, 0])
def test_lookup_keeps_rows_on_both_paths(spark, rows, limit):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    table = spark.createDataFrame([(1, 7), (5, 8)], "k long, v long")
    assert rows(joins.lookup(left, table, ["k"], limit)) == [(None, None), (1, 7), (1, 7), (2, None)]
    long = spark.createDataFrame([("f", 1, 7.0), ("g", 2, 8.0)], "feature string, at long, v double")
    out = joins.lookup_all(left, long, {"f": ["k"], "g": ["k"]}, ["at"], "v", "_v", limit)
    assert rows(out, "k", "f_v", "g_v") == [(None, None, None), (1, 7.0, None), (1, 7.0, None), (2, None, 8.0)]


def test_join_audit(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k long")
    right = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,)], "k long")
    row = joins.join_audit(left, right, ["k"], "x").first()
    assert tuple(row) == ("x", 4, 6, 1, 2)


SAMPLE = "uid long, aid long, label long, a string, b string, t string, is_train long"


def random_samples(spark, n=300, seed=8):
    rnd = random.Random(seed)
    data = []
    for uid in range(n):
        a = "hot" if uid % 3 == 0 else rnd.choice("xyz")
        data.append((uid, rnd.randrange(4), rnd.choice([-1, 0, 0, 1]), a, rnd.choice("pq"),
                     " ".join(rnd.choices("klmno", k=2)), int(rnd.random() < 0.7)))
    return data, spark.createDataFrame(data, SAMPLE)


def test_click_rates_leave_out_test_rows(spark):
    data, df = random_samples(spark)
    table = rates.click_rates(df, {"a": ["a", "aid"], "b": ["b"]})
    for r in table.collect():
        mine = [d for d in data if d[2] != -1 and (
            (d[3], str(d[1])) == (r["key1"], r["key2"]) if r["feature"] == "a" else d[4] == r["key1"])]
        assert (r["clicks"], r["exposures"]) == (sum(d[2] for d in mine), len(mine))
        assert r["ctr"] == pytest.approx(100 * sum(d[2] for d in mine) / len(mine))


def test_smoothing_of_equal_rates_keeps_them(spark):
    table = spark.createDataFrame(
        [("f", "x", 1, 2), ("f", "y", 2, 4), ("g", "x", 1, 4), ("g", "y", 3, 4), ("g", "z", 2, 4)],
        "feature string, key1 string, clicks long, exposures long",
    )
    got = {(r["feature"], r["key1"]): r["smoothed"] for r in rates.smooth_rates(table).collect()}
    assert got[("f", "x")] == 0.5
    assert 0.25 < got[("g", "x")] < 0.5 < got[("g", "y")] < 0.75


def test_out_of_fold_rates_leave_the_fold_out(spark):
    data, df = random_samples(spark)
    table = rates.out_of_fold_rates(df, ["uid"], {"b": ["b"]}, folds=3)
    folds = {r["uid"]: r["f"] for r in df.select("uid", splitting.fold(["uid"], 3).alias("f")).collect()}
    for r in table.collect():
        mine = [d for d in data if d[2] != -1 and d[4] == r["key1"] and folds[d[0]] != r["fold"]]
        assert (r["clicks"], r["exposures"]) == (sum(d[2] for d in mine), len(mine))


def test_screen_equals_auc_of_training_rates(spark):
    data, df = random_samples(spark)
    got = {r["var_name"]: r for r in screening.screen_features(df, {"a": ["a"], "aXb": ["a", "b"]}).collect()}
    known = [d for d in data if d[2] != -1]
    for name, key in (("a", lambda d: d[3]), ("aXb", lambda d: (d[3], d[4]))):
        train = [d for d in known if d[6] == 1]
        rate = {}
        for level in {key(d) for d in train}:
            mine = [d[2] for d in train if key(d) == level]
            rate[level] = sum(mine) / len(mine)
        for column, part in (("AUC_0", 1), ("AUC_1", 0)):
            pos = [rate[key(d)] for d in known if d[6] == part and d[2] == 1]
            neg = [rate[key(d)] for d in known if d[6] == part and d[2] == 0]
            won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
            assert got[name][column] == pytest.approx(won / len(pos) / len(neg))


def test_cut_search_at_full_width_covers_everything(spark):
    _, df = random_samples(spark)
    got = {r["kept"]: r for r in screening.cut_search(df, "t", [1, 5, 9]).collect()}
    assert got[5]["coverage"] == 1.0 and got[9]["coverage"] == 1.0
    assert 0 < got[1]["coverage"] < 1
    assert got[5]["AUC_1"] == got[9]["AUC_1"] and got[5]["cut_num"] == 6


def test_cut_curve_is_the_cut_search_of_every_cut(spark, rows):
    """Every cut against one built anew, in many small ranges, with tied scores and hot tokens."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    data = [
        (i % 2 if i % 3 else -1, int(rng.random() < 0.7), " ".join(rng.choices(words, [60 - w for w in range(60)], k=rng.randrange(6))) or "-1")
        for i in range(300)
    ]
    df = spark.createDataFrame(data, "label long, is_train long, t string")
    n = len({w for label, _, t in data if label >= 0 for w in t.split(" ")} - {"-1"})
    want = rows(screening.cut_search(df, "t", list(range(1, n + 1))))
    for size in (7, 1 << 16):
        assert rows(screening.cut_curve(df, "t", range_rows=size)) == want


def test_cut_curve_of_nothing(spark):
    df = spark.createDataFrame([(1, 1, "-1")], "label long, is_train long, t string")
    assert screening.cut_curve(df, "t").collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_sums_before_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    n = [0, 13, 64][seed]
    places, weights = rng.permutation(n), rng.integers(0, 9, (n, 2))
    first, second = rng.integers(0, n + 1, 50), rng.integers(0, n + 1, 50)
    got = dominance.sums_before(places, weights, first, second)
    for k, x, s in zip(first, second, got):
        assert s.tolist() == weights[:k][places[:k] < x].sum(axis=0).tolist()


def test_split_depends_on_keys_alone(spark, rows):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a, b = splitting.train_valid_split(df, ["k"], 0.3, 4)
    c, _ = splitting.train_valid_split(df.repartition(11), ["k"], 0.3, 4)
    assert rows(a) == rows(c)
    assert a.count() + b.count() == 1000
    assert 230 < b.count() < 370


def test_fill_keeps_types(spark):
    df = spark.createDataFrame([(None, None)], "s string, n long")
    assert tuple(scalars.fill_missing(df).first()) == ("-1", -1)


def test_ratio_by_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 2)], "a long, b long")
    assert [r[0] for r in df.select(scalars.ratio(F.col("a"), F.col("b"))).collect()] == [None, 0.5]


def test_tab_log_round_trip(spark, rows):
    path = f"{shared_folder(spark)}/log-round-trip"
    log = spark.createDataFrame([(1, 2), (3, 4)], "user_id long, day long")
    writers.write_csv(log, path, sep="\t")
    back = readers.read_log(spark, path, "app_launch")
    assert back.schema == schemas.APP_LAUNCH and rows(back) == [(1, 2), (3, 4)]


def test_only_the_wanted_partition_is_read(spark):
    path = f"{shared_folder(spark)}/feature-partitions"
    table = spark.createDataFrame([("a", 1), ("b", 2)], "feature string, v long")
    writers.write_features(table, path)
    plan = readers.read_features(spark, path, ["a"])
    assert [r["v"] for r in plan.collect()] == [1]
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "feature" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_headers_are_checked(spark, tmp_path):
    from cohortloom.sources import readers, schemas

    (tmp_path / "ok.csv").write_text("a,b\n1,x\n")
    (tmp_path / "turned.csv").write_text("b,a\n1,x\n")
    schema = StructType.fromDDL("a int, b string")
    assert readers.read_csv(spark, str(tmp_path / "ok.csv"), schema).collect() == [(1, "x")]
    with pytest.raises(Exception, match="header"):
        readers.read_csv(spark, str(tmp_path / "turned.csv"), schema).collect()
    names = [f.name for f in schemas.APP_LAUNCH.fields]
    (tmp_path / "log").write_text("\t".join(names[::-1]) + "\n" + "\t".join("1" for _ in names) + "\n")
    with pytest.raises(Exception, match="header"):
        readers.read_log(spark, str(tmp_path / "log"), "app_launch").collect()


# --- faulty files, buckets, sketches, likelihood --------------------------------------


def test_rows_that_do_not_parse_are_counted_and_none_is_lost(spark, rows):
    path = f"{shared_folder(spark)}/faulty"
    lines = ["user_id\tday", "1\t2", "x\t3", "4", "5\t6\t7", "", "8\t", "9\t9"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    good, rejects = readers.read_checked(spark, path, schemas.APP_LAUNCH, sep="\t")
    assert rows(good) == [(1, 2), (8, None), (9, 9)] or set(rows(good)) == {(1, 2), (8, None), (9, 9)}
    assert rows(rejects) == [("columns", "4"), ("columns", "5\t6\t7"), ("value", "x\t3")]


def test_bucketed_tables_are_joined_where_they_lie(spark, rows):
    left = spark.range(200).selectExpr("id % 20 AS uid", "id AS aid", "id * 2 AS x")
    right = spark.range(150).selectExpr("id % 20 AS uid", "id AS aid", "id * 3 AS y")
    tables = [
        writers.write_bucketed(df, ["uid", "aid"], 4, f"{shared_folder(spark)}/buckets-{name}")
        for name, df in (("left", left), ("right", right))
    ]
    joined = rates.join_bucketed(*tables, ["uid", "aid"])
    got = rows(joined, "uid", "aid", "x", "y")
    assert got == rows(left.join(right, ["uid", "aid"], "left"), "uid", "aid", "x", "y")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_united_sketches_stay_within_their_bound(spark):
    log = spark.range(60_000).selectExpr("id % 3 AS page", "id % 30 + 1 AS day", "id % 20011 AS user_id")
    stored = sketches.daily_sketches(log, ["page"], {"users": "user_id"})
    windows = [DayWindow(1, 23, 1), DayWindow(8, 16, 2)]
    found = sketches.window_estimates(stored, ["page"], ["users"], windows).collect()
    assert len(found) == 6
    for w in windows:
        exact = {
            r["page"]: r["n"] for r in log.filter(w.reads("day")).groupBy("page").agg(F.countDistinct("user_id").alias("n")).collect()
        }
        for r in found:
            if r["window"] == w.name:
                assert abs(r["users"] - exact[r["page"]]) <= sketches.error_bound() * exact[r["page"]]


@pytest.mark.parametrize("x", [0.01, 0.5, 1.0, 3.7, 60.0])
def test_digamma_is_the_slope_of_lgamma(spark, x):
    got = spark.range(1).select(rates.digamma(F.lit(x))).first()[0]
    h = 1e-4 * x
    assert got == pytest.approx((math.lgamma(x + h) - math.lgamma(x - h)) / (2 * h), abs=1e-4, rel=1e-5)


def test_likelihood_finds_planted_parameters_and_knows_where_there_are_none(spark):
    rng = np.random.default_rng(4)
    shown = rng.integers(5, 60, 4000)
    data = [("planted", int(c), int(n)) for c, n in zip(rng.binomial(shown, rng.beta(2.0, 8.0, 4000)), shown)]
    data += [("none", 0, 9)] * 5 + [("all", 4, 4)] * 5
    table = spark.createDataFrame(data, "feature string, clicks long, exposures long")
    found = {r["feature"]: r for r in rates.likelihood_parameters(table).collect()}
    assert found["planted"]["a"] == pytest.approx(2.0, rel=0.1) and found["planted"]["b"] == pytest.approx(8.0, rel=0.1)
    assert (found["none"]["a"], found["none"]["b"]) == (found["all"]["a"], found["all"]["b"]) == (0.0, 0.0)

    def likelihood(a, b):
        def beta(x, y):
            return math.lgamma(x) + math.lgamma(y) - math.lgamma(x + y)
        return sum(beta(c + a, n - c + b) - beta(a, b) for _, c, n in data[:4000])

    a, b = found["planted"]["a"], found["planted"]["b"]
    assert all(likelihood(a, b) >= likelihood(a * f, b * g) for f in (0.99, 1, 1.01) for g in (0.99, 1, 1.01))
    smoothed = {(r["feature"], r["clicks"]): r["smoothed"] for r in rates.smooth_by_likelihood(table).collect()}
    assert smoothed["none", 0] == 0.0 and smoothed["all", 4] == 1.0


def test_queries_of_one_place_are_dealt_over_groups(spark, rows, monkeypatch):
    """All queries ask for nearly one place of the second order; no group holds many of them."""
    seen = spark.sparkContext.accumulator(0)
    within = dominance._within

    def watched(points, first, second, measures):
        if len(first) > 40:
            seen.add(1)
        return within(points, first, second, measures)

    monkeypatch.setattr(dominance, "_within", watched)
    places = random.Random(3).sample(range(1, 201), 200)
    points = [(True, i + 1, p, None, i % 5) for i, p in enumerate(places)]
    queries = [(False, 1 + i % 200, 100 + i % 2, f"q{i}", None) for i in range(400)]
    df = spark.createDataFrame(points + queries, "point boolean, first long, second long, q string, n long")
    got = rows(dominance.dominated(df, ["q"], ["n"], range_rows=8), "q", "n")
    want = sorted((q, sum(p[4] for p in points if p[1] <= a and p[2] <= b)) for _, a, b, q, _ in queries)
    assert got == want and seen.value == 0


def test_screen_deals_rows_over_parts(spark, rows):
    """The parts are as many as the rows ask for, and the areas do not depend on them."""
    _, df = random_samples(spark)
    features = {"a": ["a"], "aXb": ["a", "b"]}
    keyed = []
    real = screening.keyed_rows
    screening.keyed_rows = lambda d, *rest: keyed.append(d) or real(d, *rest)
    try:
        got = rows(screening.screen_features(df, features, part_rows=10))
    finally:
        screening.keyed_rows = real
    assert keyed[0].rdd.getNumPartitions() == -(-keyed[0].count() // 10)
    assert got == rows(screening.screen_features(df, features))
