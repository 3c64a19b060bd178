"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tests.check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_entry_has_one_row_per_registrant(spark):
    df = contract.entry(spark)
    assert df.count() == df.select("user_id").distinct().count() > 0


@pytest.mark.parametrize("name", ["category_grid", "base_fits", "token_cut_fits"])
def test_penalised_fits_learn_and_do_not_exceed_one(spark, name):
    """No known optimum: in the training part every point must beat a guess."""
    for row in QUERIES[name](spark, SF_DIR).collect():
        assert 0.5 < row["train_auc"] < 1.0
        assert 0.4 < row["valid_auc"] < 0.6  # the labels do not depend on the categories


def test_stacked_categories_rank_the_training_rows_better_than_one(spark):
    grid = {(r["alpha"], r["l1_ratio"]): r["train_auc"] for r in QUERIES["category_grid"](spark, SF_DIR).collect()}
    single = {r["var_name"]: r["train_auc"] for r in QUERIES["single_fits"](spark, SF_DIR).collect()}
    assert max(grid.values()) > max(single.values())
