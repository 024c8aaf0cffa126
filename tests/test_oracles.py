"""Every query with a SQL counterpart gives the same rows as DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracles import differences
from tests.conftest import SF_DIR, plan_of

TRAINED = {
    "oof_trees", "test_trees", "tree_importance", "oof_mlp", "stack_fit", "drift_model",
    "search_params", "round_one_oof", "round_one_submission",
    "round_two_submission",
}

# functions of the user's own are Python
OWN = {"own_vote", "own_deviation", "own_row_value"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS FROM '{SF_DIR}/{file}'")
    return connection


def test_only_trained_models_lack_sql():
    own = set(entry.queries()) - set(entry._added("QUERIES"))
    assert own - set(entry.oracle_sql()) == TRAINED
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - set(entry._added("ORACLES"))))
def test_same_rows(spark, sf_dir, duck, name):
    df = entry.queries()[name](spark, sf_dir)
    plan = plan_of(df)
    assert name in OWN or "Python" not in plan
    assert "CartesianProduct" not in plan
    assert differences(df.toPandas(), duck.execute(entry.oracle_sql()[name]).df()) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "p3_particle_px" in df.columns
