"""Every registered query against its DuckDB oracle on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from cdrmill.plans.catalog import QUERIES as PLAIN
from cdrmill.plans.job_queries import JOB_QUERIES
from conftest import SF
from tools.oracle_check import digest

CATALOG = PLAIN | JOB_QUERIES
QUERIES = {n: q for n, q in E.queries().items() if n in CATALOG}
SQL = {n: q for n, q in E.oracle_sql().items() if n in CATALOG}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["lineitem", "supplier", "nation"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    a = digest(QUERIES[name](spark, SF).toPandas())
    b = digest(con.execute(SQL[name]).fetchdf())
    assert a == b


def test_entry_runs_with_a_stable_schema(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "INPUTFILENAME" in df.columns
    assert E.entry(spark).schema == df.schema
