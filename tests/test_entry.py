"""The driver contract at sf0.001: every query against its DuckDB twin."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.compare_oracle import VIEWS, compare

SF = "/root/testdata/sf0.001"
# the text operators have tests of their own
OWN = [k for k in E.queries() if not k.startswith("op") and k != "pipeline"]
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for v in VIEWS:
        path = f"{SF}/{v}.parquet"
        if os.path.exists(path):
            c.sql(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{path}')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["name", "address", "kind", "pct"]
    assert df.count() > 0


def test_every_query_has_a_twin():
    assert set(OWN) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, SF, name)
    assert r["ok"], r
