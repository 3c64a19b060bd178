"""A key with a third of all rows must not end up in one task."""

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import ordering
from cohortloom.operators import activity as act
from cohortloom.operators.windows import DayWindow


@pytest.fixture
def fixed_partitions(spark):
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def sizes(df):
    counted = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return [r["n"] for r in counted.collect()]


def test_hot_user_is_spread(spark, fixed_partitions):
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000 + 1)
    activity = spark.range(30_000).select(
        hot.alias("user_id"), (F.col("id") % 30 + 1).alias("day"), (F.col("id") % 5).alias("page"),
        F.col("id").alias("video_id"), (F.col("id") % 977).alias("author_id"), (F.col("id") % 6).alias("action_type"),
    )
    n = sizes(act.activity_things(activity))
    assert len(n) == 8 and max(n) < 1.3 * sum(n) / len(n)
    row = act.activity_per_user(activity).filter("user_id = 0").first()
    assert row["activity_frequency_total"] == row["user_video_cnt"] == 10_000


def test_hot_group_is_cut_into_ranges(spark, fixed_partitions):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "cold").otherwise("hot").alias("g"), F.col("id").alias("x"), F.lit(1).alias("n")
    )
    placed = df.repartitionByRange("g", "x")
    n = sizes(placed)
    assert len(n) == 8 and max(n) < 1.5 * sum(n) / len(n)
    got = ordering.running_totals(df, ["g"], ["x"], ["n"])
    last = {r["g"]: r["m"] for r in got.groupBy("g").agg(F.max("n_upto").alias("m")).collect()}
    assert last == {"hot": 13_333, "cold": 6_667}
    wrong = got.filter((F.col("g") == "cold") & (F.col("n_upto") != F.floor(F.col("x") / 3) + 1)).count()
    assert wrong == 0


def test_log_rows_are_moved_once_by_user(spark, fixed_partitions, rows):
    """A user's things lie in one part unless the user is hot; the rows are the same either way."""
    user = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 500 + 1)
    activity = spark.range(6_000).select(
        user.alias("user_id"), (F.col("id") % 30 + 1).alias("day"), F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("page"),
        F.col("id").alias("video_id"), (F.col("id") % 97).alias("author_id"), (F.col("id") % 6).alias("action_type"),
    )
    launch, video = activity.select("user_id", "day"), activity.filter("day < 9").select("user_id", "day")
    windows = [DayWindow(1, 16, 2), DayWindow(1, 23, 1)]
    want = rows(act.log_things(launch, video, activity, windows, hot_rows=0))
    cold = act.log_things(launch, video, activity, windows)
    plan = cold._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    parts = cold.select("user_id", F.spark_partition_id().alias("part")).groupBy("user_id").agg(F.count_distinct("part").alias("n"))
    assert parts.filter("n > 1").count() == 0
    assert rows(cold) == want
    mixed = act.log_things(launch, video, activity, windows, hot_rows=1_000, part_rows=500)
    assert rows(mixed) == want
    assert mixed.filter("user_id = 0").select(F.spark_partition_id()).distinct().count() == 8
