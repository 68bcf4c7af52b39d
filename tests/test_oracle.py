"""Every registered query against its DuckDB oracle on the smallest tables (the driver's gate at sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import rows_of  # noqa: E402
from quarry.session import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(cols) > 0
        return
    cur = duck.execute(sql)
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    assert rows_of(cols, rows) == rows_of(dcols, cur.fetchall())


def test_entry_smoke(spark):
    rows = {r.lang: r.n for r in E.entry(spark).collect()}
    assert rows == {"de": 8, "en": 69, "fr": 10}      # FIXTURES flagship at sf0.001
