"""What the operators of this folder share: words, reading tables, written steps."""

from __future__ import annotations

import re
import sys
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortloom.session import settle

# A word is a run without the six ASCII blanks; bytes.split() cuts at the same six.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = re.compile(r"[\x20\x09-\x0D]")
SQL_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).parent.parent
    # the driver serves the file as long as the application runs
    archive = f"{tempfile.mkdtemp(prefix='package-')}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    path = list(sys.path)
    context.addPyFile(archive)
    sys.path[:] = path  # the driver has the package already
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; none for null."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def map_rows(
    df: DataFrame, schema: str, rows: Callable[[pa.RecordBatch], dict[str, list]]
) -> DataFrame:
    """Apply ``rows`` to each Arrow batch; it returns the columns of ``schema`` by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = rows(batch)
            first = next(iter(out.values()))
            if len(first):
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v, pa.Array) else pa.array(v, kinds[k]) for k, v in out.items()],
                    names=list(out),
                )

    kinds = arrow_types(df.sparkSession, schema)
    return df.mapInArrow(run, schema)


def arrow_types(spark: SparkSession, schema: str) -> dict[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    return {f.name: to_arrow_type(f.dataType) for f in StructType.fromDDL(schema).fields}


class Written:
    """Tables written between steps, and dropped as soon as nothing reads them again."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[int, str] = {}

    def __call__(self, df: DataFrame) -> DataFrame:
        out = settle(df)
        self.paths[id(out)] = out.inputFiles()[0].rsplit("/", 1)[0] if out.inputFiles() else ""
        return out

    def drop(self, *tables: DataFrame) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for df in tables:
            path = self.paths.pop(id(df), "")
            if path:
                folder = hadoop.Path(path)
                folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
