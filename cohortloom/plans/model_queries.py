"""Registered queries that fit models.

Fits run until they converge, on all rows of their part. Where a model has a known optimum, the SQL
states it: a fit without a penalty on the levels of one column (or of crossed columns) scores
every level by its training rate, a penalty that is strong enough leaves one score
for all rows, and a tree over the levels of one column has a leaf for each.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortloom.functions import scalars, splitting
from cohortloom.functions.tokens import join_values
from cohortloom.operators import boosting, encoders, models, rates, screening, tokens
from cohortloom.operators.design import PARTS, Encoder, counted
from cohortloom.plans import proxies
from cohortloom.plans.activity_queries import rounded
from cohortloom.plans.file_queries import scratch
from cohortloom.plans.proxies import CATEGORIES, SAMPLES_SQL
from cohortloom.plans.sample_queries import FOUR, KEYS, two_auc_tail
from cohortloom.session import settle
from cohortloom.sources import writers

# Until the objective no longer moves.
ITERATIONS, TOL = 500, 1e-11
# Penalties without effect, and strong enough to leave only the mean.
WEAK, STRONG = 1e12, 1e-12
FOLDS = 5
# Trees that split one column apart, level by level.
TREES = {"rounds": 20, "rate": 0.1, "depth": 5, "min_rows": 1, "seed": 7}
CROSSES = ["gender_age", "gender_age_house"]


def known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled samples as a table: every fit reads them again."""
    fold = F.pmod(F.col("uid") * 7 + F.col("aid") * 3, F.lit(FOLDS)).cast("int")
    return settle(rates.labelled(proxies.marked_samples(spark, sf_dir)).withColumn("fold", fold))


def matrix_of(df: DataFrame, categories) -> DataFrame:
    return models.design_matrix(categories=categories).fit(df).transform(df)


def exact_fit():
    return models.logistic_alpha(0.0, ITERATIONS, tol=TOL)


def hash_split(spark, sf_dir):
    """Rows, clicks and distinct keys of the two parts, and the keys that are in both."""
    df = known(spark, sf_dir).select(*KEYS, "label")
    train, valid = splitting.train_valid_split(df, KEYS, 0.3, seed=20, slot=splitting.text_slot)
    parts = train.withColumn("part", F.lit("train")).unionByName(valid.withColumn("part", F.lit("valid")))
    per_key = parts.groupBy(*KEYS).agg(
        F.max("part").alias("part"), F.count(F.lit(1)).alias("n"), F.sum("label").alias("clicks"),
        F.max("part").alias("last"), F.min("part").alias("first"),
    )
    return per_key.groupBy("part").agg(
        F.sum("n").alias("n_rows"), F.sum("clicks").alias("clicks"),
        F.sum(F.when(F.col("first") != F.col("last"), 1).otherwise(0)).cast("long").alias("n_in_both"),
    )


def boosted_trees(spark, sf_dir):
    """All categories; rounds end once the area on held-out rows has not grown for 100 of them."""
    matrix = settle(matrix_of(known(spark, sf_dir), CATEGORIES).select("features", "label", "is_train"))
    model = boosting.boost(matrix, rounds=300, patience=100, rate=0.1, depth=5)
    scored = model.margins(matrix, "score")
    judged = models.judge({(model.best_round,): scored}, ["best_round"])
    return rounded(judged.withColumn("rounds", F.lit(len(model.areas))))


def rounds_auc(spark, sf_dir):
    """Both areas after each round over the levels of one column, and the round to stop at."""
    matrix = matrix_of(known(spark, sf_dir), ["gender"])
    model = boosting.boost(matrix, rounds=60, patience=20, rate=0.1, depth=5, min_rows=1)
    per_round = boosting.areas(model, spark)
    return rounded(per_round.withColumn("stop_at", F.when(F.col("round") == model.best_round, F.col("round"))))


def cross_validation(spark, sf_dir):
    """The band of the area over the folds, with no penalty and with one that leaves the mean."""
    matrix = matrix_of(known(spark, sf_dir), ["lbs"])
    make = lambda alpha: models.logistic_alpha(alpha, ITERATIONS, tol=TOL)
    return rounded(models.cross_validate(matrix, make, {"alpha": [0.0, 1e6]}, FOLDS))


def rounds_band(spark, sf_dir):
    """AUC after each boosting round over the folds, with the band around it."""
    matrix = matrix_of(known(spark, sf_dir), ["age"])
    return rounded(models.rounds_band(matrix, models.boosted_trees(**TREES), FOLDS))


def logistic_grid(spark, sf_dir):
    matrix = matrix_of(known(spark, sf_dir), ["advertiserid"])
    rows = matrix.filter(F.col("is_train") == 1).count()
    return rounded(models.grid_search(
        matrix, lambda c, iterations: models.logistic(c, rows, iterations, tol=TOL),
        {"c": [WEAK, STRONG], "iterations": [ITERATIONS]},
    ))


def elastic_grid(spark, sf_dir):
    return rounded(models.grid_search(
        matrix_of(known(spark, sf_dir), ["producttype"]),
        lambda alpha, l1_ratio: models.logistic_alpha(alpha, ITERATIONS, l1_ratio, TOL),
        {"alpha": [0.0, 100.0], "l1_ratio": [0.07, 1.0]},
    ))


def category_grid(spark, sf_dir):
    """All categories at once, at the penalties a user would try."""
    matrix = matrix_of(known(spark, sf_dir), CATEGORIES)
    return rounded(models.grid_search(
        matrix, lambda alpha, l1_ratio: models.logistic_alpha(alpha, 100, l1_ratio),
        {"alpha": [1e-4, 1e-3], "l1_ratio": [0.0, 0.07]},
    ))


def score_as_feature(spark, sf_dir):
    """A linear model over the levels of a column as numbers, its score added as a column."""
    df = known(spark, sf_dir)
    levels = [r["age"] for r in df.select("age").distinct().orderBy("age").collect()]  # five priorities
    numbers = [f"is_{i}" for i in range(len(levels))]
    wide = df.select("*", *[(F.col("age") == v).cast("double").alias(n) for n, v in zip(numbers, levels)])
    train = wide.filter(F.col("is_train") == 1)
    (scored,) = models.score_feature(train, [wide], numbers, c=WEAK, iterations=ITERATIONS, tol=TOL)
    return rounded(scored.select(*KEYS, "label", "lr_score"), 4)


def tree_leaves(spark, sf_dir):
    """Rows per tree and leaf, from the one-hot rows of the leaves."""
    matrix = matrix_of(known(spark, sf_dir), ["gender"])
    model = models.boosted_trees(leaf="leaf", **TREES).fit(matrix.filter(F.col("is_train") == 1))
    hot = encoders.leaf_one_hot(encoders.leaf_rows(model.transform(matrix), KEYS), KEYS)
    return hot.groupBy("feature", "index").agg(F.sum("value").cast("long").alias("n_rows")).drop("index")


def single_fits(spark, sf_dir):
    """Every category alone, each by a fit of its own."""
    return rounded(models.single_additions(known(spark, sf_dir), [], CATEGORIES, exact_fit))


def base_fits(spark, sf_dir):
    """Every other category on top of a base."""
    return rounded(models.single_additions(
        known(spark, sf_dir), ["gender"], [c for c in CATEGORIES if c != "gender"], lambda: models.logistic_alpha(0.001, 100)
    ))


def forward_selection(spark, sf_dir):
    """Crosses of the base in the order of the one-pass screen, added one after the other."""
    df = known(spark, sf_dir)
    df = df.select(
        "*", join_values("gender", "age").alias("gender_age"), join_values("gender", "age", "house").alias("gender_age_house")
    )
    screened = screening.screen_features(df, {c: [c] for c in CROSSES})
    ranked = [r["var_name"] for r in screened.orderBy(F.desc("AUC_1"), "var_name").collect()]
    return rounded(models.forward_selection(df, ["gender"], ranked, exact_fit))


def token_cut_fits(spark, sf_dir):
    """Fits at three cuts of the cut curve, the other tokens collapsed."""
    df = known(spark, sf_dir)
    ranked = tokens.rank_tokens(tokens.token_importance(df, ["interest1"]))
    points = {}
    for kept in (4, 8, 12):
        rare = tokens.rare_tokens(ranked, {"interest1": kept})
        cut = counted(tokens.collapse_rare(df, ["gender", "label", "is_train"], rare, ["interest1"]), parts=PARTS)
        *_, points[(kept,)] = models.fit_and_score(
            cut, models.design_matrix(categories=["gender"], tokens=["interest1"]), models.logistic_alpha(0.001, 100)
        )
    return rounded(models.judge(points, ["kept"]))


def saved_model(spark, sf_dir):
    """Fit, save, load, score: what the loaded model says about each level."""
    df = known(spark, sf_dir)
    path = scratch(spark, "model")
    encoder, model, _ = models.fit_and_score(df, models.design_matrix(categories=["creativesize"]), exact_fit())
    encoder.save(f"{path}/encoder")
    writers.write_model(model, f"{path}/model")
    matrix = Encoder.load(spark, f"{path}/encoder").transform(df.select("creativesize"))
    scored = models.positive_score(LogisticRegressionModel.load(f"{path}/model").transform(matrix))
    return rounded(scored.groupBy("creativesize", F.col("score")).agg(F.count(F.lit(1)).alias("n_rows")), 4)


def numeric_matrix(spark, sf_dir):
    """Numbers beside levels and token counts: cells, missing ones and sums of each vector."""
    df = proxies.marked_samples(spark, sf_dir)
    df = settle(df.select(
        *KEYS, "gender", "interest2", scalars.to_long(F.regexp_replace("advertiserid", "Brand#", "")).alias("brand"),
        F.when(F.col("interest2") != "-1", F.length("interest2")).alias("length"),
    ))
    blocks = models.design_matrix(categories=["gender"], tokens=["interest2"], numbers=["brand", "length"])
    path = scratch(spark, "numbers")
    writers.write_matrix(blocks.fit(df).transform(df).select(*KEYS, "features"), path)
    stored = spark.read.schema(
        "uid long, aid long, features struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"
    ).parquet(path)
    values = F.col("features.values")
    return stored.select(
        *KEYS, F.col("features.size").cast("long").alias("width"), F.size(values).cast("long").alias("cells"),
        F.size(F.filter(values, lambda v: F.isnan(v))).cast("long").alias("missing"),
        F.aggregate(F.filter(values, lambda v: ~F.isnan(v)), F.lit(0.0), lambda a, v: a + v).alias("total"),
    )


def lowered_names(spark, sf_dir):
    """Rates under capital names meet the samples once the names are lower case."""
    df = rates.labelled(proxies.marked_samples(spark, sf_dir))
    table = df.groupBy(F.col("gender").alias("Gender"), F.col("house").alias("HOUSE")).agg(
        F.count(F.lit(1)).alias("FEACNT"), F.sum("label").alias("Cnt")
    )
    return scalars.rename_all(table, str.lower)


QUERIES = {
    "hash_split": hash_split,
    "boosted_trees": boosted_trees,
    "cross_validation": cross_validation,
    "rounds_band": rounds_band,
    "rounds_auc": rounds_auc,
    "logistic_grid": logistic_grid,
    "elastic_grid": elastic_grid,
    "category_grid": category_grid,
    "score_as_feature": score_as_feature,
    "tree_leaves": tree_leaves,
    "single_fits": single_fits,
    "base_fits": base_fits,
    "forward_selection": forward_selection,
    "token_cut_fits": token_cut_fits,
    "saved_model": saved_model,
    "numeric_matrix": numeric_matrix,
    "lowered_names": lowered_names,
}


# --- SQL ------------------------------------------------------------------------------


def _rate_fits(features: dict[str, list[str]]) -> str:
    """Areas of fits without a penalty: every level of a feature is scored by its training rate."""
    levels = " UNION ALL ".join(
        f"SELECT '{name}' AS var_name, {FOUR} FROM samples WHERE label <> -1 GROUP BY {', '.join(columns)}"
        for name, columns in features.items()
    )
    return f"""{SAMPLES_SQL}, levels AS ({levels}),
      scored AS (SELECT var_name, round(tp / (tp + tn), 6) AS score, sum(tp) AS tp, sum(tn) AS tn, sum(vp) AS vp, sum(vn) AS vn
        FROM levels GROUP BY 1, 2), {two_auc_tail('var_name', 'scored')}"""


_HALF = "CAST(0.5 AS DOUBLE)"
_CROSSES = {"gender": ["gender"], "gender_age": ["gender", "age"], "gender_age_house": ["gender", "age", "house"]}


def _folds(column: str) -> str:
    """Exact areas per fold of the rates that the other folds give."""
    return f"""{SAMPLES_SQL},
      k AS (SELECT {column} AS level, (uid * 7 + aid * 3) % {FOLDS} AS fold, count(*) FILTER (label = 1) AS p,
        count(*) FILTER (label <> 1) AS n FROM samples WHERE label <> -1 GROUP BY 1, 2),
      o AS (SELECT *, (sum(p) OVER l - p) / (sum(p + n) OVER l - p - n) AS score FROM k WINDOW l AS (PARTITION BY level)),
      g AS (SELECT fold, round(score, 6) AS score, sum(p) AS p, sum(n) AS n FROM o GROUP BY 1, 2),
      c AS (SELECT *, sum(n) OVER (PARTITION BY fold ORDER BY score) - n AS below FROM g),
      a AS (SELECT fold, CAST(sum(p * (below + n / 2.0)) AS DOUBLE) / (CAST(sum(p) AS DOUBLE) * CAST(sum(n) AS DOUBLE)) AS auc
        FROM c GROUP BY 1)"""


def _band_sql(columns: str, source: str = "a") -> str:
    return f"""SELECT {columns}round(avg(auc), 6) AS auc_mean, round(stddev_pop(auc), 6) AS auc_std,
      round(avg(auc) - stddev_pop(auc), 6) AS lower, round(avg(auc) + stddev_pop(auc), 6) AS upper FROM {source}"""


_SLOT = "CAST('0x' || substr(md5(concat_ws('|', '20', uid, aid)), 1, 8) AS BIGINT) % 10000"
_LABELLED = f"WITH {SAMPLES_SQL} "
_BRAND = "TRY_CAST(replace(advertiserid, 'Brand#', '') AS BIGINT)"

ORACLES = {
    "hash_split": _LABELLED + f"""SELECT CASE WHEN {_SLOT} < 3000 THEN 'valid' ELSE 'train' END AS part,
      count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS clicks, CAST(0 AS BIGINT) AS n_in_both
      FROM samples WHERE label <> -1 GROUP BY 1""",
    "rounds_auc": f"""WITH {_rate_fits({'gender': ['gender']})}
      SELECT CAST(r AS INTEGER) AS round, AUC_0, AUC_1, CASE WHEN r = 1 THEN CAST(1 AS INTEGER) END AS stop_at
      FROM a, generate_series(1, 21) AS g(r)""",
    "cross_validation": f"""WITH {_folds('lbs')} {_band_sql('CAST(0 AS DOUBLE) AS alpha, ')}
      UNION ALL SELECT CAST(1e6 AS DOUBLE), {_HALF}, CAST(0 AS DOUBLE), {_HALF}, {_HALF}""",
    "rounds_band": f"""WITH {_folds('age')}, b AS ({_band_sql('')})
      SELECT CAST(r AS INTEGER) AS round, b.* FROM b, generate_series(1, {TREES['rounds']}) AS g(r)""",
    "logistic_grid": f"""WITH {_rate_fits({'f': ['advertiserid']})}
      SELECT CAST({WEAK} AS DOUBLE) AS c, CAST({ITERATIONS} AS INTEGER) AS iterations, AUC_0 AS train_auc, AUC_1 AS valid_auc FROM a
      UNION ALL SELECT CAST({STRONG} AS DOUBLE), CAST({ITERATIONS} AS INTEGER), {_HALF}, {_HALF}""",
    "elastic_grid": f"""WITH {_rate_fits({'f': ['producttype']})}
      SELECT alpha, l1_ratio, CASE WHEN alpha = 0 THEN AUC_0 ELSE 0.5 END AS train_auc, CASE WHEN alpha = 0 THEN AUC_1 ELSE 0.5 END AS valid_auc
      FROM a, (VALUES (CAST(0 AS DOUBLE), CAST(0.07 AS DOUBLE)), (0, 1), (100, 0.07), (100, 1)) AS v(alpha, l1_ratio)""",
    "score_as_feature": _LABELLED + """SELECT uid, aid, label,
      round(round(avg(label) FILTER (is_train = 1) OVER (PARTITION BY age), 6), 4) AS lr_score FROM samples WHERE label <> -1""",
    "tree_leaves": _LABELLED + f"""SELECT 'tree' || (t - 1) AS feature, n_rows
      FROM (SELECT gender, count(*) AS n_rows FROM samples WHERE label <> -1 GROUP BY 1), generate_series(1, {TREES['rounds']}) AS g(t)""",
    "single_fits": f"""WITH {_rate_fits({c: [c] for c in CATEGORIES})}
      SELECT var_name, AUC_0 AS train_auc, AUC_1 AS valid_auc FROM a""",
    "forward_selection": f"""WITH {_rate_fits(_CROSSES)},
      r AS (SELECT *, row_number() OVER (ORDER BY AUC_1 DESC, var_name) AS step FROM a WHERE var_name <> 'gender'),
      -- the finest cross that is in already decides the fit
      f AS (SELECT step, var_name, max(var_name) OVER (ORDER BY step) AS finest FROM r)
      SELECT CAST(step AS INTEGER) AS step, f.var_name, AUC_0 AS train_auc, AUC_1 AS valid_auc
      FROM f JOIN a ON a.var_name = finest""",
    "saved_model": _LABELLED + """SELECT creativesize, round(round(avg(label) FILTER (is_train = 1), 6), 4) AS score, count(*) AS n_rows
      FROM samples WHERE label <> -1 GROUP BY 1""",
    "numeric_matrix": _LABELLED + f""", t AS (SELECT uid, aid, {_BRAND} AS brand, CASE WHEN interest2 <> '-1' THEN length(interest2) END AS length,
        string_split(lower(interest2), ' ') AS w FROM samples)
      SELECT uid, aid, (SELECT count(DISTINCT gender) FROM samples) + 1 + (SELECT count(DISTINCT x) FROM (SELECT unnest(w) AS x FROM t)) + 2 AS width,
        CAST(1 + len(list_distinct(w)) + CASE WHEN brand = 0 THEN 1 ELSE 2 END AS BIGINT) AS cells,
        CAST((brand IS NULL)::INT + (length IS NULL)::INT AS BIGINT) AS missing,
        CAST(1 + len(w) + coalesce(brand, 0) + coalesce(length, 0) AS DOUBLE) AS total FROM t""",
    "lowered_names": _LABELLED + """SELECT gender, house, count(*) AS feacnt, CAST(sum(label) AS BIGINT) AS cnt
      FROM samples WHERE label <> -1 GROUP BY 1, 2""",
}
