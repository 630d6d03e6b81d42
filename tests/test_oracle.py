"""Every registered query against its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as entry
from oracle_util import duck, same_result
from tidemark.plans import catalog

# the training-data operators have tests of their own
QUERIES = catalog.queries()
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_oracle_or_is_documented():
    assert set(SQL) == set(QUERIES)
    assert set(SQL) <= set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, sf_small, name):
    same_result(QUERIES[name](spark, sf_small), con, SQL[name])


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "transaction_date" in df.columns


TIME_SENSITIVE = ["audit_scan", "watermark", "incremental_files", "cast_timestamp", "derive_date", "flatten_pipeline"]


@pytest.mark.parametrize("name", TIME_SENSITIVE)
def test_results_do_not_depend_on_session_time_zone(spark, con, sf_small, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        same_result(QUERIES[name](spark, sf_small), con, SQL[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
