"""Every registered query against its SQL on the smallest tables."""

import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry
import check_queries
from pactmill import plans

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_every_query_has_sql():
    assert set(plans.QUERIES) == set(plans.ORACLES)


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query_equals_sql(spark, con, name):
    said = check_queries.compare(name, entry.queries()[name](spark, SF_DIR), entry.oracle_sql()[name], con)
    assert said.startswith("ok"), said


def test_entry(spark):
    assert entry.entry(spark).count() > 0
