"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app: str = "cohortloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; the cluster's own settings win where set."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # plans name the files they read, however deep the folders are
        .config("spark.sql.maxMetadataStringLength", "1000")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local master may fall back to a folder of its own: on a cluster a
    driver-side temporary folder would be invisible to the executors.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is not None:
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="cohortloom-")
    context.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    return f"{shared_folder(spark)}/cohortloom/{spark.sparkContext.applicationId}"


def settle(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from there.

    Used where a result is read more than once and must be the same each time (row
    positions after a range partitioning) or where its size is to be counted before a
    join is chosen. Survives the loss of executors; being columnar, it can be read by
    column and its size is known to the optimizer. ``schema`` names other types of the same
    stored form, as for vectors.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def drop_settled(spark: SparkSession) -> None:
    """Delete the tables this application has settled; their results must be used up."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(folder, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use the idle cores when a scan comes as a few large row groups.

    Only a scan with fewer tasks than cores is redistributed, by columns a later join
    can use; a large table has tasks enough and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
