"""Every registered query against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import compare

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def pairs_only_equal_keys(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    problem, _ = compare(df, con, entry.oracle_sql()[name])
    assert problem is None
    pairs_only_equal_keys(df)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs_without_sql(spark, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert df.count() > 0
    pairs_only_equal_keys(df)


def test_entry_has_a_stable_schema(spark):
    first, second = entry.entry(spark), entry.entry(spark)
    assert first.schema == second.schema
    assert first.count() > 0
