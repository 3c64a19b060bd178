"""The corpus pipeline: rules, near duplicates, leaks, mixture, token files.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as Parquet in
the shared folder and reads it again as the next stage's ``docs``. All but the last keep
the columns of ``documents``. The mixture may repeat documents, so doc_id is then no
longer unique; the token files keep copies next to one another under one key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortloom.llm import decontamination, mixing, near_duplicates, queries, repetition, token_files
from cohortloom.llm.common import Written, ship, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return repetition.without_repetition(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_duplicates.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    path = token_files.shard_folder(spark)
    token_files.write_shards(docs, path, queries.tokenizer_path())
    return token_files.read_documents(spark, path)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near duplicates", near_dedup),
    ("decontamination", decontaminate),
    ("mixture", mix_sources),
    ("token ids", token_ids),
]

# Token ids and weighted samples have no SQL; tests compare run() with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    keep = Written(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir))
    return docs
