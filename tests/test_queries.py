"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as entry  # noqa: E402
from check_oracles import TABLES, canonical  # noqa: E402

from spherecube.queries import load  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(load().QUERIES))
def test_query_matches_sql(spark, con, name):
    got = canonical(entry.queries()[name](spark, SF_DIR).toPandas())
    sql = entry.oracle_sql().get(name)
    if sql is not None:
        want = canonical(con.execute(sql).df())
        assert list(got.columns) == list(want.columns)
        assert got.equals(want)


def test_entry(spark):
    assert entry.entry(spark).columns == ["time", "cell", "value"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
