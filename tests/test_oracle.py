"""Every registered query against its DuckDB oracle on the smallest driver
tables: same columns, same row count, same multiset of rows."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import rows_of  # noqa: E402
from tessera.sources.tables import TABLES  # noqa: E402

SF = os.environ.get("TESSERA_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    # the training-data operators (where present) have tests of their own
    missing = sorted(set(E.queries()) - set(E.oracle_sql()) - set(E.LLM_QUERIES))
    assert missing == []


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["department", "category", "total_units_sold", "total_revenue", "total_gross_profit", "gross_margin_pct"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(set(E.oracle_sql()) - set(E.LLM_QUERIES)))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[key])
    d_cols, d_rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_of(s_cols, s_rows, 6) == rows_of(d_cols, d_rows, 6)
