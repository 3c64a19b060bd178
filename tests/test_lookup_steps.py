"""What lookups sort and move, and that hashes of keys decide nothing."""

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import joins
from cohortloom.operators import rates


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def looked_up(spark):
    left = spark.createDataFrame(
        [(i, f"x{i % 3}" if i % 5 else None, f"y{i % 4}", i % 2) for i in range(40)], "k int, x string, y string, label int"
    )
    features = {"xy": ["x", "y"], "yx": ["y", "x"], "y": ["y"]}
    return left, rates.click_rates(left, features).drop("clicks", "exposures"), features


def test_long_lookups_sort_by_a_number_first_and_move_values_uncombined(spark, rows):
    left, table, features = looked_up(spark)
    keys = ["key1", "key2"]
    few = joins.lookup_all(left, table, features, keys, "ctr", "_ctr")
    long = joins.lookup_all(left, table, features, keys, "ctr", "_ctr", broadcast_rows=0)
    assert rows(few) == rows(long) and long.count() == 40
    text = plan(long)
    assert "Join [__hash#" in text
    # values are moved by their row as they are, and grouped there
    assert "REPARTITION_BY_COL" in text


def test_a_shared_hash_is_no_double_key(spark, monkeypatch, rows):
    left, table, features = looked_up(spark)
    keys = ["key1", "key2"]
    wanted = rows(joins.lookup_all(left, table, features, keys, "ctr", "_ctr"))
    monkeypatch.setattr(joins, "key_hash", lambda columns: F.lit(1).cast("long"))
    assert rows(joins.lookup_all(left, table, features, keys, "ctr", "_ctr", broadcast_rows=0)) == wanted
    with pytest.raises(ValueError, match="xy"):
        joins.lookup_all(left, table.unionAll(table.filter("feature = 'xy'")), features, keys, "ctr", "_ctr")
