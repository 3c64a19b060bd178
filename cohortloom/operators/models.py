"""Fits on Spark ML: boosted trees, linear models, grids and selections.

The driver sees models and metrics only; matrices come from ``design``. Scores of all grid
points are judged together by the exact metric, in one job.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce
from itertools import product
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cohortloom.operators.design import FEW, PARTS, ROWS, Blocks, Encoder, counted
from cohortloom.operators.metrics import roc_auc

T = TypeVar("T")

# Fits that run at the same time, each in a scheduling pool of its own.
PARALLEL_FITS = 4


def design_matrix(
    categories: Sequence[str] = (), tokens: Sequence[str] = (), numbers: Sequence[str] = ()
) -> Blocks:
    """One-hot, token-count and numeric blocks in one sparse vector column."""
    return Blocks(tuple(categories), tuple(tokens), tuple(numbers))


def concurrently(spark: SparkSession, jobs: Mapping[Hashable, Callable[[], T]], parallel: int = PARALLEL_FITS) -> dict[Hashable, T]:
    """Results of independent jobs by name, ``parallel`` of them at a time.

    Every job has a job group and a scheduling pool of its own: with fair scheduling they
    share the executors, and a small fit does not wait for a large one.
    """
    context = spark.sparkContext

    def run(item: tuple[Hashable, Callable[[], T]]) -> tuple[Hashable, T]:
        name, job = item
        context.setJobGroup(f"fit {name}", f"fit {name}")
        context.setLocalProperty("spark.scheduler.pool", f"fit {name}")
        return name, job()

    # wrapped one by one: each keeps local properties of its own
    wrapped = [inheritable_thread_target(spark)(partial(run, item)) for item in jobs.items()]
    with ThreadPoolExecutor(max(1, parallel)) as pool:
        return dict(pool.map(lambda job: job(), wrapped))


def boosted_trees(rounds: int = 300, rate: float = 0.02, depth: int = 5, min_rows: int = 50,
                  sample: float = 1.0, valid: str | None = None, seed: int = 0, leaf: str = "") -> GBTClassifier:
    """Boosted trees; with ``valid`` naming a boolean column, rounds stop once it no longer gains."""
    trees = GBTClassifier(maxIter=rounds, stepSize=rate, maxDepth=depth, minInstancesPerNode=min_rows,
                          subsamplingRate=sample, seed=seed, maxMemoryInMB=512, leafCol=leaf)
    return trees.setValidationIndicatorCol(valid) if valid else trees


def logistic(c: float, rows: int, iterations: int = 100, l1_ratio: float = 0.0, tol: float = 1e-4) -> LogisticRegression:
    """Logistic regression by inverse strength ``c``, as a penalty per row."""
    return logistic_alpha(1.0 / (c * rows), iterations, l1_ratio, tol)


def logistic_alpha(alpha: float, iterations: int = 100, l1_ratio: float = 0.0, tol: float = 1e-4) -> LogisticRegression:
    """The same by penalty ``alpha``, with a share ``l1_ratio`` of it on absolute values."""
    return LogisticRegression(regParam=alpha, elasticNetParam=l1_ratio, maxIter=iterations, tol=tol,
                              standardization=False)


# Decimals of a score: rows that a fit cannot tell apart are tied, whatever the last bits say.
SCORE_PLACES = 6


def positive_score(scored: DataFrame, name: str = "score", places: int = SCORE_PLACES) -> DataFrame:
    return scored.withColumn(name, F.round(vector_to_array(F.col("probability"))[1], places))


def score_feature(train: DataFrame, sets: Sequence[DataFrame], numbers: Sequence[str],
                  c: float = 500.0, iterations: int = 200, name: str = "lr_score", tol: float = 1e-4) -> list[DataFrame]:
    """Fit on ``train``, then add the score to each set as a new numeric feature."""
    filled = train.na.fill(0.0, list(numbers))
    assemble = VectorAssembler(inputCols=list(numbers), outputCol="_numbers")
    n = train.count()
    model = logistic(c, n, iterations, tol=tol).setFeaturesCol("_numbers").fit(assemble.transform(filled))
    out = []
    for df in sets:
        scored = model.transform(assemble.transform(df.na.fill(0.0, list(numbers))))
        out.append(positive_score(scored, name).drop("_numbers", "rawPrediction", "probability", "prediction"))
    return out


def judge(points: Mapping[tuple, DataFrame], names: Sequence[str]) -> DataFrame:
    """(names, train_auc, valid_auc) from scored rows (is_train, label, score) per grid point.

    Rows of ``counted`` weigh what they stand for.
    """
    tagged = [
        df.select(*[F.lit(v).alias(n) for n, v in zip(names, point)], "is_train", "label", "score",
                  F.col(ROWS) if ROWS in df.columns else F.lit(1).cast("long").alias(ROWS))
        for point, df in points.items()
    ]
    aucs = roc_auc(reduce(DataFrame.unionByName, tagged), [*names, "is_train"], weight=ROWS)
    return aucs.groupBy(*names).agg(
        F.max(F.when(F.col("is_train") == 1, F.col("auc"))).alias("train_auc"),
        F.max(F.when(F.col("is_train") == 0, F.col("auc"))).alias("valid_auc"),
    )


def grid_search(matrix: DataFrame, make, grid: Mapping[str, Sequence], parallel: int = PARALLEL_FITS) -> DataFrame:
    """Fit ``make(**point)`` on the training rows for every point; AUC on both parts.

    ``matrix`` has features, label and is_train. Every fit reads it, so it is written once,
    rows that are alike as one: the encoders are not run again, whatever becomes of the executors.
    """
    names = list(grid)
    matrix = counted(matrix.select("features", "label", "is_train"), parts=PARTS)
    train = matrix.filter(F.col("is_train") == 1)
    jobs = {
        point: lambda point=point: make(**dict(zip(names, point))).setWeightCol(ROWS).fit(train) for point in product(*grid.values())
    }
    fitted = concurrently(matrix.sparkSession, jobs, parallel)
    return judge({point: positive_score(model.transform(matrix)) for point, model in fitted.items()}, names)


def cross_validate(
    matrix: DataFrame, make, grid: Mapping[str, Sequence], folds: int = 5, parallel: int = PARALLEL_FITS
) -> DataFrame:
    """(grid columns, auc_mean, auc_std, lower, upper): the band over the folds for every point.

    ``matrix`` has features, label and fold, a number below ``folds`` that depends on the
    keys alone. Every (point, fold) is one fit on the other folds, and one job gives all
    exact areas.
    """
    names = list(grid)
    matrix = counted(matrix.select("features", "label", "fold"), parts=PARTS)
    jobs = {
        (*point, k): lambda point=point, k=k: make(**dict(zip(names, point))).setWeightCol(ROWS).fit(matrix.filter(F.col("fold") != k))
        for point in product(*grid.values()) for k in range(folds)
    }
    fitted = concurrently(matrix.sparkSession, jobs, parallel)
    tagged = [
        positive_score(model.transform(matrix.filter(F.col("fold") == at[-1]))).select(
            *[F.lit(v).alias(n) for n, v in zip(names, at)], "fold", "label", "score", ROWS
        )
        for at, model in fitted.items()
    ]
    return _band(roc_auc(reduce(DataFrame.unionByName, tagged), [*names, "fold"], weight=ROWS), names)


def _band(aucs: DataFrame, by: Sequence[str]) -> DataFrame:
    mean, spread = F.avg("auc"), F.stddev_pop("auc")
    return aucs.groupBy(*by).agg(
        mean.alias("auc_mean"), spread.alias("auc_std"),
        (mean - spread).alias("lower"), (mean + spread).alias("upper"),
    )


def scores_per_round(model: GBTClassificationModel, rows: DataFrame, keep: Sequence[str], every: int = 1) -> DataFrame:
    """(keep, round, score): what the model would say after each boosting round.

    A model's first r trees are the model of round r. The trees' values form one array,
    and its running sums are one fold over it: an expression whose size is that of the
    model, not its square. Margins are rounded, so that rows that no tree tells apart are tied.
    """
    for i, tree in enumerate(model.trees):
        rows = tree.setPredictionCol(f"_tree{i}").transform(rows)
    values = F.array(*[F.col(f"_tree{i}") * F.lit(w) for i, w in enumerate(model.treeWeights)])
    last = len(model.trees)
    sums = F.aggregate("_values", F.array(F.lit(0.0)), lambda done, v: F.array_append(done, F.element_at(done, -1) + v))
    rounds = F.array(*[F.lit(r) for r in range(1, last + 1) if r % every == 0 or r == last])
    totals = F.transform(rounds, lambda r: F.struct(r.alias("round"), F.round(F.element_at("_sums", r + 1), 9).alias("score")))
    return (
        rows.select(*keep, values.alias("_values")).withColumn("_sums", sums).select(*keep, F.inline(totals))
    )


def rounds_band(
    matrix: DataFrame, trees: GBTClassifier, folds: int = 5, every: int = 1, parallel: int = PARALLEL_FITS
) -> DataFrame:
    """(round, auc_mean, auc_std, lower, upper): cross-validated AUC after each boosting round.

    ``matrix`` has features, label and fold. One fit per fold, several at a time; one job
    judges every (fold, round).
    """
    # only trees that draw no rows and may split off any of them see no difference
    plain = trees.getSubsamplingRate() == 1.0 and trees.getMinInstancesPerNode() == 1
    matrix = counted(matrix.select("features", "label", "fold"), FEW if plain else 0)
    trees = trees.copy().setWeightCol(ROWS)
    jobs = {k: lambda k=k: trees.fit(matrix.filter(F.col("fold") != k)) for k in range(folds)}
    fitted = concurrently(matrix.sparkSession, jobs, parallel)
    judged = [
        scores_per_round(model, matrix.filter(F.col("fold") == k), ["fold", "label", ROWS], every)
        for k, model in fitted.items()
    ]
    return _band(roc_auc(reduce(DataFrame.unionByName, judged), ["fold", "round"], weight=ROWS), ["round"])


def rounds_auc(model: GBTClassificationModel, matrix: DataFrame, every: int = 1) -> DataFrame:
    """(round, AUC_0, AUC_1): area under the curve on both parts after each round."""
    aucs = roc_auc(scores_per_round(model, matrix, ["is_train", "label"], every), ["round", "is_train"])
    return aucs.groupBy("round").agg(
        F.max(F.when(F.col("is_train") == 1, F.col("auc"))).alias("AUC_0"),
        F.max(F.when(F.col("is_train") == 0, F.col("auc"))).alias("AUC_1"),
    )


def stopping_round(per_round: DataFrame, patience: int = 100, by: str = "AUC_1") -> DataFrame:
    """(round, <by>): the best round before ``patience`` rounds went by without a gain.

    There are as many rows as boosting rounds, so one window over all of them is small.
    """
    order = Window.partitionBy(F.lit(0)).orderBy("round")
    best = F.struct(F.col(by), (-F.col("round")).alias("_early"))
    so_far = per_round.select("round", by, F.max(best).over(order).alias("_best"))
    gone_by = F.col("round") + F.col("_best._early")
    stopped = F.max(F.when(gone_by >= patience, 1).otherwise(0)).over(
        order.rowsBetween(Window.unboundedPreceding, -1)
    )
    read = so_far.withColumn("_stopped", F.coalesce(stopped, F.lit(0))).filter(F.col("_stopped") == 0)
    return read.agg(F.max(best).alias("b")).select((-F.col("b._early")).alias("round"), F.col(f"b.{by}").alias(by))


def fit_and_score(samples: DataFrame, blocks: Blocks, estimator) -> tuple[Encoder, Model, DataFrame]:
    """Encoders see all rows, the estimator only training rows; returns scores for both parts.

    The fit reads rows that are alike as one; ``samples`` of ``counted`` weigh what they stand for.
    """
    encoder = blocks.fit(samples)
    matrix = encoder.transform(samples)
    alike = matrix if ROWS in matrix.columns else counted(matrix.select("features", "label", "is_train"), parts=PARTS)
    model = estimator.copy().setWeightCol(ROWS).fit(alike.filter(F.col("is_train") == 1))
    return encoder, model, positive_score(model.transform(matrix))


def _fits_of_blocks(
    samples: DataFrame, wanted: Mapping[tuple, Sequence[str]], make, names: Sequence[str], parallel: int
) -> DataFrame:
    """One fit per list of categories, all from one matrix: a fit takes its blocks as slices.

    Levels are numbered and rows encoded once, whatever the number of fits.
    """
    used = list(dict.fromkeys(c for columns in wanted.values() for c in columns))
    encoder = design_matrix(categories=used).fit(samples)
    matrix = encoder.transform(samples.select(*used, "label", "is_train"), "all_features")

    def fit(columns: Sequence[str]) -> DataFrame:
        slicer = VectorSlicer(inputCol="all_features", outputCol="features", indices=encoder.columns(columns))
        rows = counted(slicer.transform(matrix).select("features", "label", "is_train"), parts=PARTS)
        return positive_score(make().setWeightCol(ROWS).fit(rows.filter(F.col("is_train") == 1)).transform(rows))

    jobs = {point: lambda columns=columns: fit(columns) for point, columns in wanted.items()}
    return judge(concurrently(samples.sparkSession, jobs, parallel), names)


def forward_selection(
    samples: DataFrame, base: Sequence[str], candidates: Sequence[str], make, parallel: int = PARALLEL_FITS
) -> DataFrame:
    """Candidates are added one after the other and stay: (step, var_name, train_auc, valid_auc).

    ``candidates`` come in the order of a one-pass screen; each step is one fit.
    """
    wanted = {(k, c): [*base, *candidates[:k]] for k, c in enumerate(candidates, start=1)}
    return _fits_of_blocks(samples, wanted, make, ["step", "var_name"], parallel)


def single_additions(
    samples: DataFrame, base: Sequence[str], candidates: Sequence[str], make, parallel: int = PARALLEL_FITS
) -> DataFrame:
    """Each candidate alone on top of the base: (var_name, train_auc, valid_auc)."""
    return _fits_of_blocks(samples, {(c,): [*base, c] for c in candidates}, make, ["var_name"], parallel)
