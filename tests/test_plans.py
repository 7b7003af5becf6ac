"""Properties of the physical plans that large tables depend on."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as job
from transhume.operators import dedup, filters, lookup
from transhume.plans import facts
from transhume.queries.exports import _accounts, _exported
from transhume.queries.inputs import derived
from transhume.queries.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the test tables are not there")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"export_all"}))
def test_no_cross_join_and_no_python(spark, name):
    plan = physical(job.queries()[name](spark, SF_DIR))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas", plan)


def test_dedup_limits_each_key_before_the_shuffle(spark):
    plan = physical(dedup.keep_first(derived(spark, SF_DIR, "accounts"), ["purchase_id"], ["src_id"]))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")
    assert plan.count("WindowGroupLimit") == 2


def test_dedup_of_a_hot_key_shuffles_a_row_per_task(spark):
    df = spark.range(0, 100_000, 1, 8).withColumn("k", F.when(F.col("id") < 0, F.col("id")))
    kept = dedup.keep_first(df, ["k"], ["id"])
    assert [r.id for r in kept.collect()] == [0]
    assert _shuffle_records(kept) == [8]


def _shuffle_records(df) -> list[int]:
    """Records written by each shuffle of a query that has run."""
    found = []

    def walk(plan):
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(plan.executedPlan())
        if "QueryStage" in name:
            return walk(plan.plan())
        if name == "Exchange":
            found.append(plan.metrics().apply("shuffleRecordsWritten").value())
        for i in range(plan.children().size()):
            walk(plan.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_fact_export_does_not_shuffle_the_facts(spark):
    plan = physical(facts.export_deals(derived(spark, SF_DIR, "deals"), _exported(spark, SF_DIR), id_keys=["deal_id"]))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    scan = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert "l_linestatus" not in scan


def test_large_lookups_shuffle_instead_of_broadcasting(spark, shuffled_joins):
    df = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    dim = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    plan = physical(lookup.lookup(df, dim, "l_orderkey", "o_orderkey", {"s": "o_orderstatus"}, unique=True))
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan


def test_only_hot_keys_are_broadcast_when_salting(spark, shuffled_joins):
    df = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    dim = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    salted = lookup.lookup(
        df, dim, "l_orderkey", "o_orderkey", {"s": "o_orderstatus"}, unique=True, salt_hot=F.col("l_partkey"),
        hot_rows=5,
    )
    plan = physical(salted)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan
    assert salted.count() == df.count()


def test_hot_lookup_keys_are_split_at_run_time(spark, shuffled_joins):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts_ = spark.range(0, 20_000, 1, 8).withColumn("k", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500))
        dim = spark.range(500).select(F.col("id").alias("key"), F.md5(F.col("id").cast("string")).alias("v"))
        df = lookup.lookup(facts_, dim, "k", "key", {"v": "v"}, unique=True)
        assert len(df.collect()) == 20_000
        assert "skew=true" in physical(df)
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_filters_and_columns_reach_the_scan(spark):
    df = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").select("l_orderkey", "l_returnflag", "l_tax")
    plan = physical(filters.slice_by_key(df, "l_orderkey", "42").select("l_tax"))
    assert "EqualTo(l_orderkey,42)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_tax:double>" in plan
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    plan = physical(filters.since_days(orders, "o_orderdate", dt.datetime(2000, 6, 30)).select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate" in plan
    plan = physical(filters.keep_members(orders, "o_orderstatus", ["F", "O"]))
    assert "In(o_orderstatus" in plan


def test_lookups_by_login_share_one_partitioning(spark, shuffled_joins):
    """After the dedup by login, the lookups by login add no shuffle of the accounts."""
    plan = physical(_accounts(spark, SF_DIR, keep_secrets=True))
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(login" in line]
    assert len(wide) == 1


def test_shared_counts_are_computed_once(spark):
    df = job.queries()["account_distributions"](spark, SF_DIR)
    df.collect()
    final = physical(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def test_salted_lookups_do_not_repeat_the_facts(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id % 3 AS a", "id % 5 AS b", "id % 7 AS c").write.parquet(str(tmp_path / "facts"))
    facts_table = spark.read.parquet(str(tmp_path / "facts"))
    df = facts_table
    for key in "abc":
        dim = spark.range(10).selectExpr("id AS k", f"id * 10 AS {key}_value")
        taken = {f"{key}_value": f"{key}_value"}
        df = lookup.lookup(df, dim, key, "k", taken, unique=True, salt_hot=F.col("id"), hot_rows=100, hot_in=facts_table)
    assert len(re.findall(r"FileScan parquet \[[^\]]*a#[^\]]*b#", physical(df))) == 1
    assert df.where("a_value = a * 10 AND b_value = b * 10 AND c_value = c * 10").count() == 1000


@pytest.mark.parametrize("name", ["keep_first", "duplicate_count", "lookup_two_hop"])
def test_wide_keys_travel_as_digests(spark, shuffled_joins, name):
    plan = physical(QUERIES[name](spark, SF_DIR))
    moved = re.findall(r"(?:Exchange hashpartitioning|Sort \[|SortMergeJoin)[^\n]*", plan)
    assert moved and not any(re.search(r"\b(body|text)#", line) for line in moved)


@pytest.mark.parametrize("salted", [False, True])
def test_orphans_are_not_shuffled(spark, shuffled_joins, monkeypatch, salted):
    monkeypatch.setattr(lookup, "SIFT_FROM", 1)
    deals = spark.range(0, 40_000, 1, 4).selectExpr(
        "id AS deal_id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN CAST(id AS STRING) END AS trading_account"
    )
    accounts = spark.range(0, 5_000).selectExpr("CAST(id AS STRING) AS platform_login_id", "'u' || id AS uuid")
    df = facts.export_deals(deals, accounts, id_keys=["deal_id"], spread_by=F.col("deal_id") if salted else None)
    assert {(r.deal_id, r.platform_account_uuid) for r in df.collect()} == {(i, f"u{i}") for i in range(1, 5_000, 3)}
    assert sum(_shuffle_records(df)) < 5_000 + 2 * 1_667


def test_a_sieve_drops_no_row_with_a_match(spark):
    keys = spark.range(3_000).select((F.col("id") * 7).alias("id"))
    table = lookup.as_lookup_table(keys, "id", {"v": "id"}, text=True, unique=True)
    rows = spark.range(21_000).select(F.when(F.col("id") < 20_900, F.col("id")).cast("string").alias("k"))
    passed = {r.k for r in lookup.sifted(rows, table, F.col("k"), 1).collect()}
    assert {str(7 * i) for i in range(2_986)} <= passed and len(passed) < 3_500 and None not in passed
    assert lookup.sifted(rows, table, F.col("k"), 3_001).count() == 21_000
    assert lookup.sifted(rows, table.limit(0), F.col("k"), 0).count() == 21_000


@pytest.mark.parametrize("name", ["export_purchases", "export_platform_accounts"])
def test_keys_of_purchases_are_made_after_the_lookups(spark, shuffled_joins, name):
    plan = physical(QUERIES[name](spark, SF_DIR))
    assert "concat_ws(|, purchases" in plan
    moved = re.findall(r"Exchange hashpartitioning\((?:id|user_id|__lookup_key)#.*?FileScan", plan, re.S)
    assert moved and not any("concat_ws(|, purchases" in part for part in moved)


def test_a_slice_by_account_shuffles_a_row_per_login_and_task(spark, shuffled_joins):
    deals = spark.range(0, 40_000, 1, 4).selectExpr(
        "id AS deal_id", "CASE WHEN id % 3 > 0 THEN 'b' WHEN id > 39000 THEN 'a' WHEN id > 38000 THEN 'lost' END AS trading_account"
    )
    accounts = spark.createDataFrame([("b", "u2"), ("a", "u1"), ("idle", "u0")], "platform_login_id string, uuid string")
    first = facts.first_account(deals, accounts)
    logins = accounts.select(first.alias("uuid"))
    assert {r.uuid for r in logins.collect()} == {"u1"}
    df = facts.export_deals_of(deals, accounts, first, id_keys=["deal_id"])
    assert {r.deal_id for r in df.collect()} == {i for i in range(39_001, 40_000) if i % 3 == 0}
    plan = physical(df)
    assert sum(_shuffle_records(df)) == 0 and "SortMergeJoin" not in plan.split("Subquery")[0]
    whole = facts.export_deals(deals, accounts, id_keys=["deal_id"])
    assert sorted(map(str, facts.slice_deals(whole, "u1").collect())) == sorted(map(str, df.collect()))


def test_the_first_account_is_found_without_a_task_that_takes_a_hot_login_whole(spark, shuffled_joins):
    plan = physical(QUERIES["export_slice_by_account"](spark, SF_DIR))
    moved = [part for part in re.findall(r"Exchange hashpartitioning.*?FileScan[^\n]*", plan, re.S) if "lineitem" in part]
    assert moved and all("HashAggregate(keys=[" in part for part in moved)
