"""Registered queries that go through files: what is written is read back and compared."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cohortloom.operators import encoders, models, rates, tokens
from cohortloom.plans import proxies
from cohortloom.plans.activity_queries import rounded
from cohortloom.plans.proxies import CATEGORIES, LOGS_SQL, TOKEN_COLUMNS, USER_ATTRIBUTES
from cohortloom.plans.sample_queries import ATTRIBUTE_AD, COMBOS, ORACLES as SAMPLE_ORACLES, kept_samples, samples
from cohortloom.session import run_folder, settle
from cohortloom.sources import readers, schemas, writers


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for each run, in the folder shared by all executors."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


SAMPLE_SCHEMA = StructType(
    [StructField(c, LongType()) for c in ("uid", "aid", "label")]
    + [StructField(c, StringType()) for c in (*CATEGORIES, *TOKEN_COLUMNS)]
)


def csv_with_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "samples")
    writers.write_csv(samples(spark, sf_dir).select(*SAMPLE_SCHEMA.names), path)
    return readers.read_csv(spark, path, SAMPLE_SCHEMA)


def csv_named_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file without a header; its keys are typed by the schema."""
    path = scratch(spark, "exposures")
    writers.write_csv(rates.exposures(samples(spark, sf_dir)), path, header=False)
    schema = StructType([StructField("aid", LongType()), StructField("exposures", LongType())])
    return readers.read_named_csv(spark, path, schema)


def csv_first_row_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header that says something else than the schema: it is dropped."""
    path = scratch(spark, "smoothed")
    pairs = rates.token_pair_rates(samples(spark, sf_dir), TOKEN_COLUMNS).select("uid", "aid", "interest1ctr")
    writers.write_csv(pairs.toDF("a", "b", "c"), path)
    schema = schemas.pair_schema("interest1ctr")
    return rounded(readers.read_skipping_first(spark, path, schema))


def tab_separated_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "user_activity")
    log = proxies.user_activity(spark, sf_dir).select(*schemas.USER_ACTIVITY.names)
    writers.write_csv(log, path, sep="\t")
    return readers.read_log(spark, path, "user_activity").groupBy("page", "action_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("day").alias("days"), F.sum("video_id").alias("videos"),
    )


# A fault in every 101st and every 103rd video's lines.
BAD_VALUE, BAD_COLUMNS = 101, 103


def log_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log with lines that do not parse: what was read, and how many lines were not and why."""
    path = scratch(spark, "faulty_activity")
    day = F.when(F.col("video_id") % BAD_VALUE == 0, F.lit("day")).otherwise(F.col("day").cast("string"))
    columns = [F.col(c).cast("string") if c != "day" else day for c in schemas.USER_ACTIVITY.names]
    line = F.concat_ws("\t", *[F.coalesce(c, F.lit("")) for c in columns])
    short = F.concat_ws("\t", *[F.coalesce(c, F.lit("")) for c in columns[:-1]])
    log = proxies.user_activity(spark, sf_dir)
    log.select(F.when(F.col("video_id") % BAD_COLUMNS == 0, short).otherwise(line).alias("value")).write.text(path)
    good, rejects = readers.read_checked(spark, path, schemas.USER_ACTIVITY, sep="\t", header=False)
    read = good.agg(
        F.lit("read").alias("status"), F.count(F.lit(1)).alias("n"), F.sum("day").alias("days"), F.sum("video_id").alias("videos")
    )
    lost = rejects.groupBy(F.col("reason").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return read.unionByName(lost, allowMissingColumns=True)


def tokens_by_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight token columns in one call: the listed number of each stays, by importance from a file."""
    df = settle(proxies.user_tokens(spark, sf_dir))
    columns = list(schemas.TOKENS_KEPT)
    # what a model would have said: users of a token, weighed by its length
    weight = F.col("importance") * F.length("token")
    path = scratch(spark, "importance")
    writers.write_csv(
        tokens.token_importance(df, columns).select("feature", F.col("token").alias("feature_value"), weight.alias("import_value")),
        path, header=False,
    )
    read = readers.read_named_csv(spark, path, schemas.TOKEN_IMPORTANCE)
    importance = read.select("feature", F.col("feature_value").alias("token"), F.col("import_value").alias("importance"))
    kept = tokens.keep_top(df, ["uid"], importance)
    return kept.select("uid", *[F.md5(c).alias(c) for c in columns])


# Files per bucketed table.
BUCKETS = 8


def bucketed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of values per (uid, aid), written in buckets and joined as they lie."""
    df = samples(spark, sf_dir)
    rates_of, counts_of = (
        writers.write_bucketed(table, ["uid", "aid"], BUCKETS, scratch(spark, "bucketed"))
        for table in (rates.token_pair_rates(df, TOKEN_COLUMNS), rates.attach_counts(df, COMBOS))
    )
    return rounded(rates.join_bucketed(rates_of, counts_of, ["uid", "aid"]))


def one_feature_of_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of all features in one table; only two of its partitions are read."""
    path = scratch(spark, "rates")
    writers.write_features(rates.click_rates(samples(spark, sf_dir), ATTRIBUTE_AD), path)
    table = readers.read_features(spark, path, ["age", "house"])
    return rounded(table.select("feature", "key1", "key2", "clicks", "exposures", "ctr"))


def dictionary_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "dictionary")
    writers.write_dictionary(encoders.fit_codes(samples(spark, sf_dir), CATEGORIES), path)
    schema = StructType(
        [StructField("index", LongType()), StructField("val", StringType()), StructField("feature", StringType())]
    )
    return readers.read_csv(spark, path, schema)


def key_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the test rows, as a submission needs them."""
    path = scratch(spark, "keys")
    writers.write_keys(samples(spark, sf_dir).filter(F.col("label") == -1), path)
    schema = StructType([StructField("aid", LongType()), StructField("uid", LongType())])
    return readers.read_csv(spark, path, schema)


def saved_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse rows written and read; their non-zero cells and the sum of them."""
    path = scratch(spark, "matrix")
    df = kept_samples(spark, sf_dir)
    blocks = models.design_matrix(categories=USER_ATTRIBUTES, tokens=["interest1"])
    writers.write_matrix(blocks.fit(df).transform(df).select("uid", "aid", "features"), path)
    # a stored vector is a struct; read as one, a sparse row stays as short as it is
    stored = spark.read.schema(
        "uid long, aid long, features struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"
    ).parquet(path)
    return stored.select(
        "uid", "aid",
        F.size("features.values").cast("long").alias("cells"),
        F.aggregate("features.values", F.lit(0.0), lambda a, v: a + v).alias("total"),
    )


QUERIES = {
    "csv_with_header": csv_with_header,
    "csv_named_by_position": csv_named_by_position,
    "csv_first_row_skipped": csv_first_row_skipped,
    "tab_separated_log": tab_separated_log,
    "log_with_rejects": log_with_rejects,
    "bucketed_pairs": bucketed_pairs,
    "tokens_by_importance": tokens_by_importance,
    "one_feature_of_many": one_feature_of_many,
    "dictionary_file": dictionary_file,
    "key_frame": key_frame,
    "saved_matrix": saved_matrix,
}

def _importance_sql() -> str:
    """Ranks by summed length over the users of a token; what is past the listed number is 'other'."""
    parts, joins = [], []
    for f, kept in schemas.TOKENS_KEPT.items():
        parts.append(f"""{f}_t AS (SELECT uid, place, tok FROM (SELECT uid, unnest(string_split({f}, ' ')) AS tok,
            generate_subscripts(string_split({f}, ' '), 1) AS place FROM user_tokens)),
          {f}_r AS (SELECT tok, row_number() OVER (ORDER BY count(*) * length(tok) DESC, tok) AS pos FROM {f}_t GROUP BY tok),
          {f}_o AS (SELECT uid, md5(string_agg(CASE WHEN pos > {kept} THEN 'other' ELSE tok END, ' ' ORDER BY place)) AS {f}
            FROM {f}_t JOIN {f}_r USING (tok) GROUP BY uid)""")
        joins.append(f"JOIN {f}_o USING (uid)")
    return f"WITH {proxies.USER_TOKENS_SQL}, {', '.join(parts)} SELECT uid, {', '.join(f'{f}_o.{f}' for f in schemas.TOKENS_KEPT)} FROM user_tokens {' '.join(joins)}"


_WITH = f"WITH {proxies.SAMPLES_SQL} "

ORACLES = {
    "csv_with_header": _WITH + f"SELECT {', '.join(SAMPLE_SCHEMA.names)} FROM samples",
    "csv_named_by_position": _WITH + "SELECT aid, count(*) AS exposures FROM samples GROUP BY 1",
    "csv_first_row_skipped": f"SELECT uid, aid, interest1ctr FROM ({SAMPLE_ORACLES['ctr_tokens']})",
    "tab_separated_log": f"""WITH {LOGS_SQL} SELECT page, action_type, count(*) AS n, CAST(sum(day) AS BIGINT) AS days,
      CAST(sum(video_id) AS BIGINT) AS videos FROM activity GROUP BY 1, 2""",
    "log_with_rejects": f"""WITH {LOGS_SQL} SELECT CASE WHEN video_id % {BAD_COLUMNS} = 0 THEN 'columns' WHEN video_id % {BAD_VALUE} = 0 THEN 'value'
        ELSE 'read' END AS status, count(*) AS n, CASE WHEN status = 'read' THEN CAST(sum(day) AS BIGINT) END AS days,
        CASE WHEN status = 'read' THEN CAST(sum(video_id) AS BIGINT) END AS videos FROM activity GROUP BY 1""",
    "bucketed_pairs": f"SELECT * FROM ({SAMPLE_ORACLES['ctr_tokens']}) JOIN ({SAMPLE_ORACLES['combination_counts']}) USING (uid, aid)",
    "tokens_by_importance": _importance_sql(),
    "one_feature_of_many": f"SELECT * FROM ({SAMPLE_ORACLES['ctr_attribute_ad_table']}) WHERE feature IN ('age', 'house')",
    "dictionary_file": SAMPLE_ORACLES["label_codes"],
    "key_frame": _WITH + "SELECT aid, uid FROM samples WHERE label = -1",
    "saved_matrix": _WITH + f"""SELECT uid, aid,
      CAST({len(USER_ATTRIBUTES)} + len(list_distinct(string_split(interest1, ' '))) AS BIGINT) AS cells,
      CAST({len(USER_ATTRIBUTES)} + len(string_split(interest1, ' ')) AS DOUBLE) AS total FROM samples""",
}
