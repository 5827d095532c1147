"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, compare  # noqa: E402

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    r = compare(spark, SF, name, E.queries()[name], E.oracle_sql()[name], con)
    assert r["status"] == "OK", r


def test_every_query_runs_and_entry(spark):
    assert E.entry(spark).count() > 0
    rows_only = [n for n in E.queries() if n not in E.oracle_sql()]
    for n in rows_only:
        assert E.queries()[n](spark, SF).count() >= 0, n
