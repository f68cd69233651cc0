"""Every registered query against its SQL, over whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from smeltwork.queries import ALL
from tools.check_queries import TABLES, compare

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def connection():
    made = duckdb.connect()
    for table in TABLES:
        made.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return made


@pytest.mark.parametrize("name", list(ALL))
def test_query_equals_its_sql(spark, connection, name):
    good, note = compare(spark, connection, SF_DIR, name)
    assert good, note


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0


def test_sample_is_a_share_of_the_table(spark):
    rows = ALL["snapshot_sample"].run(spark, SF_DIR).count()
    assert 0.15 * 1500 < rows < 0.35 * 1500
