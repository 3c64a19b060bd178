import math
import threading

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import joins, scalars
from cohortloom.operators import boosting, design, models, rates
from cohortloom.operators.design import Encoder
from cohortloom.session import shared_folder


def test_stopping_round(spark):
    aucs = [0.5, 0.6, 0.55, 0.58, 0.57, 0.9]
    df = spark.createDataFrame([(i + 1, a) for i, a in enumerate(aucs)], "round int, AUC_1 double")
    assert tuple(models.stopping_round(df, patience=3).first()) == (2, 0.6)
    assert tuple(models.stopping_round(df, patience=10).first()) == (6, 0.9)


def test_last_round_scores_are_the_model(spark):
    data = [(float(i % 7), float(i % 3), i % 2 if i % 5 else 1, int(i % 4 != 0)) for i in range(200)]
    df = spark.createDataFrame(data, "a double, b double, label int, is_train int")
    matrix = models.design_matrix(numbers=["a", "b"]).fit(df).transform(df)
    model = models.boosted_trees(rounds=3, rate=0.3, depth=2, min_rows=1).fit(matrix)
    last = models.scores_per_round(model, matrix, ["a", "b"]).filter(F.col("round") == 3).distinct()
    whole = models.vector_to_array(F.col("rawPrediction"))[1]
    raw = model.transform(matrix).select("a", "b", (whole / 2).alias("margin")).distinct()
    joined = last.join(raw, ["a", "b"]).collect()
    assert joined and all(r["score"] == pytest.approx(r["margin"]) or r["score"] == pytest.approx(2 * r["margin"]) for r in joined)


# --- design matrix --------------------------------------------------------------------


SAMPLES = [
    (1, "b", "x y x", 2.0), (2, "a", "Y", None), (3, "b", "-1", 0.0), (4, None, None, -3.5), (5, "a", "x  y", 1.0),
]


def samples(spark):
    return spark.createDataFrame(SAMPLES, "k long, c string, t string, n double")


def dense(df):
    return {r["k"]: [None if math.isnan(v) else v for v in r["features"].toArray()] for r in df.collect()}


def test_vectors_equal_the_rows_by_hand(spark):
    df = samples(spark)
    encoder = models.design_matrix(["c"], ["t"], ["n"]).fit(df)
    # a, b, unknown | '', '-1', x, y | n
    assert dense(encoder.transform(df)) == {
        1: [0, 1, 0, 0, 0, 2, 1, 2.0], 2: [1, 0, 0, 0, 0, 0, 1, None], 3: [0, 1, 0, 0, 1, 0, 0, 0],
        4: [0, 0, 1, 0, 0, 0, 0, -3.5], 5: [1, 0, 0, 1, 0, 1, 1, 1.0],
    }
    assert encoder.columns(["n", "c"]) == [7, 0, 1, 2]


def test_levels_and_tokens_that_were_not_fitted(spark):
    encoder = models.design_matrix(["c"], ["t"]).fit(samples(spark))
    new = spark.createDataFrame([(9, "z", "w x")], "k long, c string, t string")
    assert dense(encoder.transform(new)) == {9: [0, 0, 1, 0, 0, 1, 0]}


def test_encoder_is_saved_and_loaded(spark):
    df = samples(spark)
    path = f"{shared_folder(spark)}/encoder"
    encoder = models.design_matrix(["c"], ["t"], ["n"]).fit(df)
    encoder.save(path)
    assert dense(Encoder.load(spark, path).transform(df)) == dense(encoder.transform(df))


def test_an_empty_table_has_vectors_of_unknowns_only(spark):
    df = samples(spark).limit(0)
    encoder = models.design_matrix(["c"], ["t"], ["n"]).fit(df)
    assert encoder.size == 2 and encoder.transform(df).collect() == []


def test_too_many_columns_are_refused(spark):
    blocks = models.design_matrix(["c"])
    with pytest.raises(ValueError):
        Encoder(blocks, spark.createDataFrame([], "feature string, val string, index long"), {"c": (1 << 31) - 1})


# --- concurrent fits ------------------------------------------------------------------


def labelled(spark, n=400):
    rows = [(f"l{i % 7}", f"m{i % 5}", int((i * i) % 11 < 4 + i % 7 % 3), int(i % 3 != 0)) for i in range(n)]
    return spark.createDataFrame(rows, "a string, b string, label int, is_train int")


def test_concurrent_fits_equal_serial_ones(spark, rows):
    df = labelled(spark)
    make = lambda: models.logistic_alpha(0.01, 50)
    results = [
        (rows(models.single_additions(df, ["a"], ["b"], make, parallel)), rows(models.forward_selection(df, [], ["a", "b"], make, parallel)))
        for parallel in (1, 3)
    ]
    assert results[0] == results[1]


def test_encoders_run_once_per_screen(spark, monkeypatch):
    calls = []
    fit, transform = models.Blocks.fit, Encoder.transform
    monkeypatch.setattr(models.Blocks, "fit", lambda self, df: calls.append("fit") or fit(self, df))
    monkeypatch.setattr(Encoder, "transform", lambda self, *a: calls.append("transform") or transform(self, *a))
    models.forward_selection(labelled(spark), [], ["a", "b"], lambda: models.logistic_alpha(0.01, 5))
    assert calls == ["fit", "transform"]


def test_every_job_has_its_own_group_and_errors_come_through(spark):
    context = spark.sparkContext
    barrier = threading.Barrier(3, timeout=60)

    def job(k):
        def run():
            barrier.wait()  # all three are under way
            return k, context.getLocalProperty("spark.jobGroup.id"), context.getLocalProperty("spark.scheduler.pool")
        return run

    found = models.concurrently(spark, {k: job(k) for k in range(3)}, parallel=3)
    assert found == {k: (k, f"fit {k}", f"fit {k}") for k in range(3)}
    with pytest.raises(ZeroDivisionError):
        models.concurrently(spark, {0: lambda: 1, 1: lambda: 1 // 0})


# --- boosting -------------------------------------------------------------------------


def test_boosting_stops_on_the_area_and_scores_as_its_trees(spark):
    df = labelled(spark)
    matrix = models.design_matrix(["a", "b"]).fit(df).transform(df)
    model = boosting.boost(matrix, rounds=12, patience=4, rate=0.5, depth=3, min_rows=1, every=3)
    aucs = [a[2] for a in model.areas]
    best = aucs.index(max(aucs)) + 1
    assert model.best_round == best and len(model.areas) >= min(12, best)
    scored = model.margins(matrix, "score", every=2)
    judged = models.judge({(0,): scored}, ["x"]).first()
    assert judged["train_auc"] == pytest.approx(model.areas[best - 1][1])
    assert judged["valid_auc"] == pytest.approx(model.areas[best - 1][2])


def test_looks_do_not_change_the_rounds(spark):
    df = labelled(spark)
    matrix = models.design_matrix(["a"]).fit(df).transform(df)
    one, four = (boosting.boost(matrix, rounds=4, patience=9, rate=0.3, min_rows=1, every=e).areas for e in (1, 4))
    assert [a[1:] for a in one] == [pytest.approx(a[1:]) for a in four]


def test_boosting_without_training_rows_is_refused(spark):
    df = labelled(spark).withColumn("is_train", F.lit(0))
    with pytest.raises(ValueError):
        boosting.boost(models.design_matrix(["a"]).fit(df).transform(df))


# --- lookups past the budget ----------------------------------------------------------


def lookup_case(spark, n_features):
    names = [f"f{i}" for i in range(n_features)]
    left = spark.createDataFrame(
        [(i, f"a{i % 3}", f"b{i % 4}" if i % 5 else None) for i in range(60)], "k long, x string, y string"
    )
    table = spark.createDataFrame(
        [(f, f"a{i}", f"b{j}", float(i + j + k)) for k, f in enumerate(names) for i in range(2) for j in range(4)]
        + [("g", f"a{i}", "unused", float(i)) for i in range(3)],
        "feature string, at_1 string, at_2 string, v double",
    )
    return left, table, {f: ["x", "y"] for f in names} | {"g": ["x"]}


def exchanges(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")


def test_lookups_past_the_budget_equal_broadcast_ones(spark, rows):
    left, table, keys = lookup_case(spark, 3)
    args = (keys, ["at_1", "at_2"], "v", "_v")
    few, none = joins.lookup_all(left, table, *args), joins.lookup_all(left, table, *args, broadcast_rows=0)
    assert rows(few) == rows(none) and few.columns == none.columns
    assert none.count() == 60


def test_lookups_past_the_budget_are_two_joins_whatever_their_number(spark):
    def n_joins(n):
        left, table, keys = lookup_case(spark, n)
        return exchanges(joins.lookup_all(left, table, keys, ["at_1", "at_2"], "v", "_v", broadcast_rows=0))

    assert n_joins(1) == n_joins(6) == 2


def test_wide_pairs_keep_every_table(spark, rows):
    long = spark.createDataFrame(
        [(1, 1, "a", 0.5), (1, 1, "b", 0.25), (2, 1, "b", 1.0)], "uid long, aid long, feature string, value double"
    )
    assert rows(rates.widen_pairs(long, ["a", "b"])) == [(1, 1, 0.5, 0.25), (2, 1, None, 1.0)]


def test_column_moves_and_renames(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a long, b long, c long")
    assert scalars.place_columns(df, "c", 1).columns == ["a", "c", "b"]
    assert scalars.rename_all(df, lambda c: f"p{c}", keep=["a"]).columns == ["a", "pb", "pc"]
    assert df.select(scalars.recode(F.col("a"), 1, 0)).first()[0] == 0


# --- rows that are alike ----------------------------------------------------------------


def matrix_of_levels(spark, n=600):
    df = labelled(spark, n)
    return models.design_matrix(["a"]).fit(df).transform(df)


def test_fits_read_rows_that_are_alike_once(spark, monkeypatch):
    """What a fit is given grows with the kinds of rows, not with the rows."""
    given = []
    monkeypatch.setattr(models, "PARTS", 20)
    for module in (models, boosting):
        monkeypatch.setattr(module, "counted", lambda *a, **k: given.append(design.counted(*a, **k)) or given[-1])
    for n in (600, 1200):
        df = labelled(spark, n)
        matrix = matrix_of_levels(spark, n)
        boosting.boost(matrix, rounds=1, patience=9, min_rows=1)
        models.grid_search(matrix, lambda alpha: models.logistic_alpha(alpha, 5), {"alpha": [0.1]})
        models.single_additions(df, [], ["a"], lambda: models.logistic_alpha(0.1, 5))
        folds = matrix.withColumn("fold", F.col("is_train"))
        models.rounds_band(folds, models.boosted_trees(2, 0.1, 2, 1), 2)
        models.cross_validate(folds, lambda alpha: models.logistic_alpha(alpha, 5), {"alpha": [0.1]}, 2)
        models.fit_and_score(df, models.design_matrix(["a"]), models.logistic_alpha(0.1, 5))
    assert len(given) == 12 and all(df.count() <= 7 * 2 * 2 + 20 for df in given)
    assert [df.agg(F.sum(design.ROWS)).first()[0] for df in given] == [600] * 6 + [1200] * 6


def test_weighed_boosting_equals_row_by_row(spark, monkeypatch):
    matrix = matrix_of_levels(spark)
    results = []
    for few in (0, 10_000):
        monkeypatch.setattr(boosting, "counted", lambda m, few=few: design.counted(m, few))
        results.append(boosting.boost(matrix, rounds=4, patience=9, rate=0.3, depth=3, min_rows=40).areas)
    assert len(results[0]) == 4 and [a[1:] for a in results[0]] == [pytest.approx(a[1:]) for a in results[1]]


def test_weighed_bands_and_grids_equal_row_by_row(spark, rows, monkeypatch):
    # rates that lie apart: where two splits gain the same, the last bits would choose
    data = [(f"l{i % 5}", int((i // 5 * 37) % 100 < 11 + (i % 5) ** 2 * 4), i % 2, i // 5 % 2) for i in range(1000)]
    df = spark.createDataFrame(data, "a string, label int, is_train int, fold int")
    matrix = models.design_matrix(["a"]).fit(df).transform(df)
    results = []
    for few in (0, 10_000):
        monkeypatch.setattr(models, "counted", lambda m, _=0, few=few, parts=None: design.counted(m, few, parts))
        band = models.rounds_band(matrix, models.boosted_trees(3, 0.3, 3, 1), 2)
        grid = models.grid_search(matrix, lambda alpha: models.logistic_alpha(alpha, 50, tol=1e-9), {"alpha": [0.01]})
        results.append(rows(band.select(*[F.round(c, 6) for c in band.columns])) + rows(grid.select(*[F.round(c, 6) for c in grid.columns])))
    assert results[0] == results[1]


def test_leaves_keep_their_least_number_of_rows(spark):
    """Rows are counted, not kinds: with more than half of them in a leaf no tree splits."""
    matrix = matrix_of_levels(spark, 300)
    model = boosting.boost(matrix, rounds=2, patience=9, min_rows=150)
    assert all(t.numNodes == 1 for t in model.trees)
    assert any(t.numNodes > 1 for t in boosting.boost(matrix, rounds=2, patience=9, min_rows=20).trees)


def test_many_kinds_of_rows_stay_as_they_are(spark):
    df = spark.range(50).select(F.col("id").alias("label"), (F.col("id") % 2).alias("is_train"))
    assert design.counted(df, 10).filter(F.col(design.ROWS) == 1).count() == 50


def test_a_kind_of_rows_is_dealt_over_parts(spark):
    df = spark.range(1000).select((F.col("id") % 10 == 0).alias("label"))
    found = design.counted(df, parts=50).groupBy("label").agg(F.sum(design.ROWS).alias("n"), F.max(design.ROWS).alias("most"))
    assert sorted(map(tuple, found.collect())) == [(False, 900, 20), (True, 100, 20)]
    assert design.counted(df, parts=5000).count() == 1000
