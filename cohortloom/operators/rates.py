"""Click-rate tables by any combination of columns, their smoothing, and their lookup."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.functions.joins import lookup_all
from cohortloom.functions.scalars import ratio
from cohortloom.functions.splitting import fold
from cohortloom.functions.tokens import join_values
from cohortloom.session import settle
from cohortloom.sources.schemas import MISSING

Features = Mapping[str, Sequence[str]]


def key_names(features: Features) -> list[str]:
    depth = max(len(columns) for columns in features.values())
    return [f"key{i + 1}" for i in range(depth)]


def keyed_rows(df: DataFrame, features: Features, keep: Sequence[str]) -> DataFrame:
    """(keep, feature, key1, key2 ..): every row once per feature, in one pass.

    Keys are text; a feature with fewer keys leaves the last ones NULL.
    """
    names = key_names(features)
    parts = []
    for feature, columns in features.items():
        keys = [f"CAST(`{c}` AS STRING)" for c in columns]
        keys += ["CAST(NULL AS STRING)"] * (len(names) - len(columns))
        parts.append(f"'{feature}', {', '.join(keys)}")
    stacked = f"stack({len(parts)}, {', '.join(parts)}) AS (feature, {', '.join(names)})"
    return df.selectExpr(*[f"`{c}`" for c in keep], stacked)


def labelled(samples: DataFrame) -> DataFrame:
    """Rows with a known label; test rows are marked by -1."""
    return samples.filter(F.col("label") != -1)


def click_rates(samples: DataFrame, features: Features, scale: float = 100.0) -> DataFrame:
    """(feature, key1 .., clicks, exposures, ctr) for all features at once.

    Counting is combined map-side: a key with a third of all rows is one row per task.
    """
    names = key_names(features)
    counted = (
        keyed_rows(labelled(samples), features, ["label"])
        .groupBy("feature", *names)
        .agg(F.sum("label").alias("clicks"), F.count(F.lit(1)).alias("exposures"))
    )
    return counted.withColumn("ctr", ratio(F.col("clicks"), F.col("exposures")) * F.lit(scale))


def smooth_rates(rates: DataFrame, value: str = "smoothed") -> DataFrame:
    """Add (clicks + a) / (exposures + a + b) per feature.

    a and b fit a beta distribution to the mean and variance of the feature's rates. Where
    that has no solution (all rates equal, or spread wider than a beta allows) the plain
    rate is kept.
    """
    raw = ratio(F.col("clicks"), F.col("exposures"))
    # one row per feature name
    moments = rates.groupBy("feature").agg(
        F.avg(raw).alias("_mean"), F.var_samp(raw).alias("_var")
    )
    mean, var = F.col("_mean"), F.col("_var")
    strength = F.when(var > 0, F.try_divide(mean * (1 - mean), var) - 1)
    usable = strength > 0
    a = F.when(usable, mean * strength).otherwise(0.0)
    b = F.when(usable, (1 - mean) * strength).otherwise(0.0)
    known = rates.join(F.broadcast(moments), "feature").withColumns({"a": a, "b": b})
    return known.withColumn(
        value, ratio(F.col("clicks") + F.col("a"), F.col("exposures") + F.col("a") + F.col("b"))
    ).drop("_mean", "_var")


def digamma(x: Column) -> Column:
    """The derivative of the logarithm of the gamma function, for x > 0, to about ten digits."""
    y = x + 6.0
    inverse = 1.0 / y
    square = inverse * inverse
    series = square * (1 / 12 - square * (1 / 120 - square * (1 / 252 - square * (1 / 240 - square / 132))))
    return F.log(y) - inverse / 2 - series - sum((1.0 / (x + float(j)) for j in range(6)), F.lit(0.0))


# The parameters of a beta distribution that a fit may reach; beyond them there is no optimum.
_LEAST, _MOST = 1e-6, 1e9


def likelihood_parameters(rates: DataFrame, tol: float = 1e-6, rounds: int = 100) -> DataFrame:
    """(feature, a, b, steps): the beta distribution that makes clicks out of exposures likeliest.

    A step is the fixed point of the beta-binomial likelihood, from sums over the distinct
    pairs of clicks and exposures, which are counted once and written: its cost depends on how
    many there are and not on the keys. All features step together, beginning at their
    moments; after every second step the two are extrapolated, as the plain iteration
    only creeps. A feature whose likelihood has no optimum (no clicks, only clicks, or rates
    that are closer together than chance) ends with 0 for both.
    """
    spark = rates.sparkSession
    pairs = settle(
        rates.filter(F.col("exposures") > 0).groupBy("feature", "clicks", "exposures").agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    start = smooth_rates(rates).groupBy("feature").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    # one row per feature name
    now = {r["feature"]: (r["a"] or 1.0, r["b"] or 1.0) for r in start.collect()}
    steps = dict.fromkeys(now, 0)
    before: dict[str, list[tuple[float, float]]] = {f: [v] for f, v in now.items()}
    moving = set(now)
    for _ in range(rounds):
        if not moving:
            break
        for f, new in _likelihood_step(pairs, {f: now[f] for f in moving}).items():
            old, now[f] = now[f], new
            steps[f] += 1
            if not all(_LEAST < v < _MOST for v in new):
                now[f] = (0.0, 0.0)
                moving.discard(f)
            elif all(abs(x - y) <= tol * y for x, y in zip(new, old)):
                moving.discard(f)
            else:
                before[f].append(new)
                if len(before[f]) == 3:
                    now[f] = _extrapolated(*before[f])
                    before[f] = [now[f]]
    return spark.createDataFrame([(f, *now[f], steps[f]) for f in now], "feature string, a double, b double, steps int")


def _likelihood_step(pairs: DataFrame, now: Mapping[str, tuple[float, float]]) -> dict[str, tuple[float, float]]:
    a = b = F.when(F.lit(False), 0.0)
    for feature, (x, y) in now.items():
        a, b = a.when(F.col("feature") == feature, F.lit(x)), b.when(F.col("feature") == feature, F.lit(y))
    clicks, shown = F.col("clicks"), F.col("exposures")
    known = pairs.filter(F.col("feature").isin(list(now))).withColumns({"_a": a, "_b": b})
    a, b = F.col("_a"), F.col("_b")
    sums = known.groupBy("feature").agg(
        F.sum(F.col("n") * (digamma(clicks + a) - digamma(a))).alias("up_a"),
        F.sum(F.col("n") * (digamma(shown - clicks + b) - digamma(b))).alias("up_b"),
        F.sum(F.col("n") * (digamma(shown + a + b) - digamma(a + b))).alias("down"),
    )
    return {
        r["feature"]: tuple(v * r[u] / r["down"] if r["down"] > 0 else 0.0 for v, u in zip(now[r["feature"]], ("up_a", "up_b")))
        for r in sums.collect()
    }


def _extrapolated(first: tuple[float, float], second: tuple[float, float], third: tuple[float, float]) -> tuple[float, float]:
    """Where three steps lead, on the scale of logarithms; the last of them if that is too far."""
    x = [[math.log(v) for v in p] for p in (first, second, third)]
    gain = [b - a for a, b in zip(x[0], x[1])]
    bend = [c - 2 * b + a for a, b, c in zip(*x)]
    size = math.hypot(*bend)
    if size == 0:
        return third
    factor = -max(1.0, math.hypot(*gain) / size)
    ahead = [a - 2 * factor * g + factor * factor * v for a, g, v in zip(x[0], gain, bend)]
    if max(abs(p - q) for p, q in zip(ahead, x[2])) > 2.0:
        return third
    return tuple(math.exp(v) for v in ahead)


def smooth_by_likelihood(rates: DataFrame, value: str = "smoothed", tol: float = 1e-6, rounds: int = 100) -> DataFrame:
    """``smooth_rates`` with the parameters of the greatest likelihood."""
    known = rates.join(F.broadcast(likelihood_parameters(rates, tol, rounds).drop("steps")), "feature")
    return known.withColumn(value, ratio(F.col("clicks") + F.col("a"), F.col("exposures") + F.col("a") + F.col("b")))


def attach_rates(
    rows: DataFrame,
    rates: DataFrame,
    features: Features,
    value: str = "ctr",
    suffix: str = "_ctr",
    gap: float | None = None,
) -> DataFrame:
    """Look up one rate per feature; ``gap`` fills what was never seen."""
    names = key_names(features)
    text = rows.withColumns(
        {f"_{c}": F.col(c).cast("string") for columns in features.values() for c in columns}
    )
    keys = {f: [f"_{c}" for c in columns] for f, columns in features.items()}
    # one name for the lookup columns and the key columns would clash
    tables = rates.select("feature", *[F.col(n).alias(f"at_{n}") for n in names], value)
    joined = lookup_all(text, tables, keys, [f"at_{n}" for n in names], value, suffix)
    wanted = [
        (F.coalesce(F.col(f"{f}{suffix}"), F.lit(gap)) if gap is not None else F.col(f"{f}{suffix}"))
        .alias(f"{f}{suffix}")
        for f in features
    ]
    return joined.select(*rows.columns, *wanted)


def out_of_fold_rates(
    samples: DataFrame, keys: Sequence[str], features: Features, folds: int = 5, seed: int = 0, own_fold: str | None = None
) -> DataFrame:
    """Click rates that leave out the fold of the row they are looked up for.

    Counted per (feature, keys, fold) once; the rate seen by a fold is the total of the key
    minus its own part. Give training rows only, or labels of the others would leak. The
    fold comes from the keys, or from the column ``own_fold``.
    """
    names = key_names(features)
    number = F.col(own_fold) if own_fold else fold(keys, folds, seed)
    per_fold = (
        keyed_rows(labelled(samples).withColumn("fold", number), features, ["fold", "label"])
        .groupBy("feature", *names, "fold")
        .agg(F.sum("label").alias("own_clicks"), F.count(F.lit(1)).alias("own_exposures"))
    )
    whole = per_fold.groupBy("feature", *names).agg(
        F.sum("own_clicks").alias("all_clicks"), F.sum("own_exposures").alias("all_exposures"),
        F.collect_list(F.struct("fold", "own_clicks", "own_exposures")).alias("_own"),
    )
    # at most one entry per fold
    return whole.select(
        "feature", *names, "all_clicks", "all_exposures", F.inline("_own")
    ).select(
        "feature", *names, "fold",
        (F.col("all_clicks") - F.col("own_clicks")).alias("clicks"),
        (F.col("all_exposures") - F.col("own_exposures")).alias("exposures"),
    ).withColumn("ctr", ratio(F.col("clicks"), F.col("exposures")) * 100.0)


def token_pair_rates(samples: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Average click rate of a row's tokens with its ad, per (uid, aid) and token column.

    Clicks are added up per (feature, text, aid) first: tokens are listed once for a text and
    an ad, however many rows have both. Rates are counted per (feature, token, aid) from
    that, looked up for the tokens of each text, and a row reads the sum and number of its text's.
    All joins are keyed by the ad too, so a token that is everywhere is spread over the
    ads. A pair without tokens stays, its averages NULL.
    """
    filled = samples.filter(F.col("label").isNotNull()).na.fill(MISSING, list(columns))
    rows = filled.select("uid", "aid", "label", *columns).unpivot(["uid", "aid", "label"], list(columns), "feature", "text")
    known = F.col("label") != -1
    texts = settle(rows.groupBy("feature", "text", "aid").agg(
        F.coalesce(F.sum(F.when(known, F.col("label"))), F.lit(0)).alias("clicks"), F.count(F.when(known, 1)).alias("shown")
    ))
    tokens = texts.select("*", F.explode(F.split("text", " ")).alias("token"))
    seen = tokens.filter((F.col("token") != MISSING) & (F.col("shown") > 0)).groupBy("feature", "token", "aid").agg(
        ratio(F.sum("clicks"), F.sum("shown")).alias("rate")
    )
    of_text = tokens.join(seen, ["feature", "token", "aid"]).groupBy("feature", "text", "aid").agg(
        F.sum("rate").alias("total"), F.count("rate").alias("n")
    )
    joined = rows.join(of_text, ["feature", "text", "aid"], "left")

    def average(column: str) -> Column:
        mine = F.col("feature") == column
        return ratio(F.sum(F.when(mine, F.col("total"))), F.sum(F.when(mine, F.col("n"))))

    return joined.groupBy("uid", "aid").agg(*[average(c).alias(f"{c}ctr") for c in columns])


def exposures(samples: DataFrame, key: str = "aid") -> DataFrame:
    """How often each ad (or other key) was shown, test rows included."""
    return samples.groupBy(key).agg(F.count(F.lit(1)).alias("exposures"))


def combined_keys(samples: DataFrame, combos: Features) -> DataFrame:
    """(uid, aid, feature, key): the joined values of each combination."""
    columns = [join_values(*cs).alias(name) for name, cs in combos.items()]
    return samples.select("uid", "aid", *columns).unpivot(
        ["uid", "aid"], list(combos), "feature", "key"
    )


def combination_counts(samples: DataFrame, combos: Features) -> DataFrame:
    """(feature, key, n): rows per combination of values."""
    columns = [join_values(*cs).alias(name) for name, cs in combos.items()]
    return (
        samples.select(*columns).unpivot([], list(combos), "feature", "key")
        .groupBy("feature", "key").agg(F.count(F.lit(1)).alias("n"))
    )


def attach_counts(samples: DataFrame, combos: Features) -> DataFrame:
    """(uid, aid, <combination>_n ..): the count of the combination a row belongs to."""
    columns = {f"_{name}": join_values(*cs) for name, cs in combos.items()}
    counts = combination_counts(samples, combos).withColumnRenamed("key", "at")
    rows = samples.select("uid", "aid", *[c.alias(n) for n, c in columns.items()])
    joined = lookup_all(rows, counts, {name: [f"_{name}"] for name in combos}, ["at"], "n", "_n")
    return joined.select("uid", "aid", *[f"{name}_n" for name in combos])


def pair_shares(samples: DataFrame, ads: Sequence[str], users: Sequence[str]) -> DataFrame:
    """(feature, ad_value, user_value, n, share): how a user attribute spreads inside an ad attribute."""
    features = {f"{a}_{u}": [a, u] for a in ads for u in users}
    pairs = (
        keyed_rows(samples, features, [])
        .groupBy("feature", "key1", "key2").agg(F.count(F.lit(1)).alias("n"))
    )
    inside = pairs.groupBy("feature", "key1").agg(F.sum("n").alias("whole"))
    return pairs.join(inside, ["feature", "key1"]).select(
        "feature", F.col("key1").alias("ad_value"), F.col("key2").alias("user_value"), "n",
        ratio(F.col("n"), F.col("whole")).alias("share"),
    )


def widen_pairs(tables: DataFrame, features: Sequence[str], value: str = "value") -> DataFrame:
    """Many (uid, aid) tables as one wide table: stacked long, then one aggregate.

    Sixty joins on the same keys become one; the wide table is joined once.
    """
    def cell(feature: str) -> Column:
        return F.max(F.when(F.col("feature") == feature, F.col(value))).alias(feature)

    return tables.groupBy("uid", "aid").agg(*[cell(f) for f in features])


def join_bucketed(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """A join of two tables bucketed alike by their keys: bucket meets bucket, nothing is moved."""
    return left.hint("merge").join(right, list(keys), how)
