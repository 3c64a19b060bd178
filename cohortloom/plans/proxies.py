"""The four logs and the ad samples, drawn from the given tables.

Days: every date is counted in steps of 84 days from 1995-01-01, which maps the whole
order history onto the days 1 to 30 of the data model; event dates are counted in days
from 2024-01-01. No table is cut down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from cohortloom.session import spread

# First dates, step and value lists of the given tables.
ORDER_START = "1995-01-01"
ORDER_STEP = 84
EVENT_START = "2024-01-01"
PROXY_PAGES = [1, 2, 3, 4, 5, 6, 7]
PROXY_ACTIONS = [0, 1, 2]
RETURN_FLAGS = "ANR"
EVENT_TYPES = ["view", "click", "error", "purchase", "signup"]


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its footer is read once, later reads know the schema."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _step(column: str) -> F.Column:
    return F.expr(
        f"CAST(datediff(to_date({column}), DATE'{ORDER_START}') DIV {ORDER_STEP} + 1 AS BIGINT)"
    )


def user_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that ordered: the day of their first order, segment and nation."""
    first = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("first_order"))
    )
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.conv(F.substring(F.md5("c_mktsegment"), 1, 8), 16, 10).cast("long").alias("register_type"),
        F.col("c_nationkey").cast("long").alias("device_type"),
    )
    return first.join(customer, "o_custkey", "left").select(
        F.col("o_custkey").alias("user_id"),
        _step("first_order").alias("register_day"),
        "register_type",
        "device_type",
    )


def app_launch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .select(F.col("o_custkey").alias("user_id"), _step("o_orderdate").alias("day"))
        .distinct()
    )


def video_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders; several a day are several rows."""
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderstatus") == "F")
        .select(F.col("o_custkey").alias("user_id"), _step("o_orderdate").alias("day"))
    )


def user_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate"
    )
    return (
        spread(lines, "l_orderkey")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_custkey").alias("user_id"),
            _step("l_shipdate").alias("day"),
            F.col("l_linenumber").cast("long").alias("page"),
            F.col("l_partkey").alias("video_id"),
            F.col("l_suppkey").alias("author_id"),
            (F.instr(F.lit(RETURN_FLAGS), F.col("l_returnflag")) - 1)
            .cast("long").alias("action_type"),
        )
    )


def event_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small, dense log: few users, many rows per user and day."""
    kinds = F.array(*[F.lit(t) for t in EVENT_TYPES])
    return table(spark, sf_dir, "events").select(
        "user_id",
        (F.datediff(F.to_date("ts"), F.lit(EVENT_START)) + 1).cast("long").alias("day"),
        (F.array_position(kinds, F.col("event_type")) - 1).cast("long").alias("page"),
    )


def event_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of the event log with the day of their first signup."""
    return (
        event_activity(spark, sf_dir)
        .filter(F.col("page") == EVENT_TYPES.index("signup"))
        .groupBy("user_id").agg(F.min("day").alias("register_day"))
    )


def four_logs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    return (
        user_register(spark, sf_dir),
        app_launch(spark, sf_dir),
        video_create(spark, sf_dir),
        user_activity(spark, sf_dir),
    )


# The same in SQL, as common table expressions.

_SQL_STEP = f"CAST(date_diff('day', DATE '{ORDER_START}', CAST({{0}} AS DATE)) // {ORDER_STEP} + 1 AS BIGINT)"

LOGS_SQL = f"""
register AS (
  SELECT o_custkey AS user_id, {_SQL_STEP.format('min(o_orderdate)')} AS register_day,
         min(CAST('0x' || substr(md5(c_mktsegment), 1, 8) AS BIGINT)) AS register_type,
         min(CAST(c_nationkey AS BIGINT)) AS device_type
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY o_custkey),
launch AS (
  SELECT DISTINCT o_custkey AS user_id, {_SQL_STEP.format('o_orderdate')} AS day FROM orders),
video AS (
  SELECT o_custkey AS user_id, {_SQL_STEP.format('o_orderdate')} AS day
  FROM orders WHERE o_orderstatus = 'F'),
activity AS (
  SELECT o_custkey AS user_id, {_SQL_STEP.format('l_shipdate')} AS day,
         CAST(l_linenumber AS BIGINT) AS page, l_partkey AS video_id, l_suppkey AS author_id,
         CAST(instr('{RETURN_FLAGS}', l_returnflag) - 1 AS BIGINT) AS action_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

EVENTS_SQL = f"""
event_activity AS (
  SELECT user_id, CAST(date_diff('day', DATE '{EVENT_START}', CAST(ts AS DATE)) + 1 AS BIGINT) AS day,
         CAST(list_position([{', '.join(repr(t) for t in EVENT_TYPES)}], event_type) - 1 AS BIGINT) AS page
  FROM events),
event_register AS (
  SELECT user_id, min(day) AS register_day FROM event_activity
  WHERE page = {EVENT_TYPES.index('signup')} GROUP BY user_id)"""


# --- ad samples -----------------------------------------------------------------------

USER_ATTRIBUTES = ["lbs", "age", "gender", "house"]
AD_ATTRIBUTES = ["advertiserid", "producttype", "creativesize"]
TOKEN_COLUMNS = ["interest1", "interest2"]
CATEGORIES = USER_ATTRIBUTES + AD_ATTRIBUTES


def ad_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (customer, part): clicked if a line of it was returned.

    Lines of a pending order have no known outcome: they are the test rows, label -1.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"
    )
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    pairs = (
        spread(lines, "l_orderkey")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("uid"), F.col("l_partkey").alias("aid"))
        .agg(
            F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).cast("long").alias("clicked"),
            F.min("o_orderpriority").alias("age"),
            F.max("o_orderstatus").alias("house"),
        )
    )
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("uid"),
        F.col("c_nationkey").cast("string").alias("lbs"),
        F.col("c_mktsegment").alias("gender"),
    )
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("aid"),
        F.col("p_brand").alias("advertiserid"),
        F.col("p_type").alias("producttype"),
        F.col("p_size").cast("string").alias("creativesize"),
        F.col("p_name").alias("interest1"),
        F.when(F.col("p_size") > 5, F.concat_ws(" ", "p_brand", "p_type", "p_brand")).alias("interest2"),
    )
    return pairs.join(customer, "uid", "left").join(part, "aid", "left").select(
        "uid", "aid",
        F.when(F.col("house") == "P", -1).otherwise(F.col("clicked")).cast("long").alias("label"),
        *CATEGORIES, *TOKEN_COLUMNS,
    )


def marked_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples with missing text filled and a training mark by the key."""
    mark = F.when(F.pmod(F.col("uid") * 31 + F.col("aid") * 17, F.lit(10)) < 7, 1).otherwise(0)
    return ad_samples(spark, sf_dir).na.fill("-1").withColumn("is_train", mark.cast("long"))


# What each token column of a user lists, of the lines they ordered.
USER_TOKENS = {
    "appidaction": "p_brand", "appidinstall": "l_partkey", "kw1": "l_suppkey", "kw2": "p_name", "kw3": "l_partkey",
    "topic1": "p_type", "topic2": "p_size", "topic3": "l_orderkey",
}


def user_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user with eight token columns: the distinct things of their lines, in order of their text."""
    lines = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey"), "l_orderkey")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("uid"))
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type", "p_size", "p_name")
    bought = lines.join(orders, "l_orderkey").join(part, "l_partkey", "left")
    # lines are moved once, by user, before any token is made of them
    moved = bought.select("uid", *dict.fromkeys(USER_TOKENS.values())).repartition("uid")
    made = moved.select(
        "uid", *[F.replace(F.col(c).cast("string"), F.lit(" "), F.lit("_")).alias(f) for f, c in USER_TOKENS.items()]
    ).filter(F.coalesce(*USER_TOKENS).isNotNull())
    return made.groupBy("uid").agg(*[F.array_join(F.array_sort(F.collect_set(f)), " ").alias(f) for f in USER_TOKENS])


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label and score with many ties."""
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("long").alias("label"),
        F.col("l_discount").alias("score"),
        F.col("l_linenumber").cast("long").alias("part"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts of all documents."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts of the labelled documents, quality as the label."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("long").alias("label"))
    return (
        documents(spark, sf_dir).join(labels, "doc_id")
        .withColumn("is_train", F.when(F.pmod("doc_id", F.lit(10)) < 7, 1).otherwise(0).cast("long"))
    )


SAMPLES_SQL = """
raw AS (
  SELECT o_custkey AS uid, l_partkey AS aid,
         CASE WHEN max(o_orderstatus) = 'P' THEN -1 ELSE max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) END AS label,
         min(o_orderpriority) AS age, max(o_orderstatus) AS house
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
ad AS (
  SELECT uid, aid, CAST(label AS BIGINT) AS label, CAST(c_nationkey AS VARCHAR) AS lbs, age, c_mktsegment AS gender,
         house, p_brand AS advertiserid, p_type AS producttype, CAST(p_size AS VARCHAR) AS creativesize,
         p_name AS interest1,
         CASE WHEN p_size > 5 THEN p_brand || ' ' || p_type || ' ' || p_brand END AS interest2
  FROM raw LEFT JOIN customer ON c_custkey = uid LEFT JOIN part ON p_partkey = aid),
samples AS (
  SELECT * REPLACE (coalesce(lbs, '-1') AS lbs, coalesce(age, '-1') AS age, coalesce(gender, '-1') AS gender,
         coalesce(house, '-1') AS house, coalesce(advertiserid, '-1') AS advertiserid,
         coalesce(producttype, '-1') AS producttype, coalesce(creativesize, '-1') AS creativesize,
         coalesce(interest1, '-1') AS interest1, coalesce(interest2, '-1') AS interest2),
         CAST(CASE WHEN (uid * 31 + aid * 17) % 10 < 7 THEN 1 ELSE 0 END AS BIGINT) AS is_train
  FROM ad)"""

USER_TOKENS_SQL = "user_tokens AS (SELECT o_custkey AS uid, " + ", ".join(
    f"string_agg(DISTINCT replace(CAST({c} AS VARCHAR), ' ', '_'), ' ' ORDER BY replace(CAST({c} AS VARCHAR), ' ', '_')) AS {f}"
    for f, c in USER_TOKENS.items()
) + """ FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1)"""

DOCUMENTS_SQL = """
docs AS (
  SELECT doc_id, text, CAST(quality AS BIGINT) AS label,
         CAST(CASE WHEN doc_id % 10 < 7 THEN 1 ELSE 0 END AS BIGINT) AS is_train
  FROM documents JOIN labels USING (doc_id))"""
