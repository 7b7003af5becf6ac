"""Every query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as job
from check import compare, connect
from transhume.queries.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the test tables are not there")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR) == []


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(job.queries())


def test_entry_has_rows_and_target_columns(spark):
    from transhume.schemas import TARGETS

    df = job.entry(spark)
    assert df.columns == TARGETS["deals"]
    assert df.count() > 0


@pytest.mark.parametrize(
    "name",
    ["export_platform_accounts", "export_deals", "export_deals_salted", "export_purchases", "lookup_hot_key", "audit_accounts"],
)
def test_query_agrees_without_broadcast(spark, con, shuffled_joins, name):
    assert compare(spark, con, name, SF_DIR) == []
