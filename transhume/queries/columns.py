"""Projections, filters, rules and scalar functions over the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from transhume import rulebook
from transhume.functions.keys import code_from, uuid_from
from transhume.functions.parse import SECONDS_SHAPE, as_date, as_timestamp, try_timestamp
from transhume.operators import conform, filters, rules
from transhume.plans.accounts import with_account_rules
from transhume.queries.inputs import derived, with_inputs
from transhume.queries.registry import code_sql, query, table, uuid_sql
from transhume.rulebook import AccountRules

NAMES = AccountRules("demo\\Acme")


@query(f"SELECT {uuid_sql('customer', 'c_custkey')} AS uuid, c_custkey FROM customer")
def surrogate_uuid(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(uuid_from("customer", "c_custkey").alias("uuid"), "c_custkey")


@query(
    f"""SELECT event_id, event_type, CASE WHEN event_type = 'signup' THEN 'AFF-' || {code_sql('payout', 'event_id')} END
        AS code FROM events"""
)
def random_code_by_type(spark, sf_dir):
    code = F.when(F.col("event_type") == "signup", F.concat(F.lit("AFF-"), code_from("payout", "event_id")))
    return table(spark, sf_dir, "events").select("event_id", "event_type", code.alias("code"))


@query(
    """SELECT c_mktsegment AS segment, c_custkey, c_name, c_name AS label, 'admin' AS kind, 0 AS used,
              CAST(NULL AS VARCHAR) AS deleted_at FROM customer"""
)
def conform_soft(spark, sf_dir):
    df = conform.rename(table(spark, sf_dir, "customer"), {"c_mktsegment": "segment", "absent": "nowhere"})
    df = conform.copy_columns(df, {"label": "c_name", "other": "absent"})
    df = conform.with_constants(df, {"kind": F.lit("admin")})
    df = conform.with_defaults(
        df, {"used": F.lit(0), "deleted_at": F.lit(None).cast("string"), "c_name": F.lit("never used")}
    )
    wanted = ["segment", "absent", "c_custkey", "c_name", "label", "kind", "used", "deleted_at"]
    return conform.select_available(df, wanted)


@query("SELECT c_acctbal, c_custkey, c_name FROM customer")
def conform_strict(spark, sf_dir):
    return conform.select_required(table(spark, sf_dir, "customer"), ["c_acctbal", "c_custkey", "c_name"])


@query("SELECT o_orderkey AS id, o_custkey, o_orderstatus AS status, o_orderdate FROM orders")
def rename_drop(spark, sf_dir):
    df = conform.rename(table(spark, sf_dir, "orders"), {"o_orderkey": "id", "o_orderstatus": "status"})
    return conform.drop_if_present(conform.drop_required(df, ["o_totalprice"]), ["o_orderpriority", "absent"])


@query("SELECT o_orderkey, o_orderpriority, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def move_column(spark, sf_dir):
    return conform.move_before(table(spark, sf_dir, "orders"), "o_orderpriority", "o_custkey")


@query("SELECT s_suppkey, CAST(NULL AS VARCHAR) AS s_name, s_nationkey, 'hidden' AS s_acctbal FROM supplier")
def redact_and_overwrite(spark, sf_dir):
    df = conform.redact(table(spark, sf_dir, "supplier"), ["s_name", "absent"])
    return conform.with_constants(df, {"s_acctbal": F.lit("hidden")})


@query(
    """SELECT c_custkey, nullif(CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END, '') AS segment,
              coalesce(CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(c_custkey % 4 AS INTEGER) END, 0) AS checked,
              0 AS agreed FROM customer"""
)
def blank_and_fill(spark, sf_dir):
    key = F.col("c_custkey")
    df = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(key % 4 != 0, key % 4).alias("check"),
    )
    df = conform.fill_cast(conform.blanks_to_null(df, ["segment", "absent"]), {"checked": "check", "agreed": "absent"})
    return df.drop("check")


@query(
    """SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(trunc(l_quantity) AS INTEGER) AS l_quantity,
              CAST(l_linenumber AS DOUBLE) AS l_linenumber, l_linenumber % 2 <> 0 AS odd,
              CAST(trunc(l_extendedprice) AS BIGINT) AS l_extendedprice FROM lineitem"""
)
def cast_family(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_linenumber", (F.col("l_linenumber") % 2).alias("odd"), "l_extendedprice"
    )
    types = {
        "l_orderkey": "string",
        "l_quantity": "int",
        "l_linenumber": "double",
        "odd": "boolean",
        "l_extendedprice": "bigint",
    }
    return conform.cast_columns(df, types)


@query(
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderdate AS at_seconds, o_orderdate AS at_guessed,
              CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate END AS at_lenient FROM orders"""
)
def parse_times(spark, sf_dir):
    text = F.col("o_orderdate").cast("string")
    spoiled = F.when(F.col("o_orderkey") % 5 == 0, F.lit("0000-00-00 00:00:00")).otherwise(text)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        as_date(F.substring(text, 1, 10)).alias("day"),
        as_timestamp(text, SECONDS_SHAPE).alias("at_seconds"),
        as_timestamp(F.replace(text, F.lit(" "), F.lit("T"))).alias("at_guessed"),
        try_timestamp(spoiled).alias("at_lenient"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice - nullif(l_tax, 0) AS profit,
              CAST(l_suppkey AS VARCHAR) AS target FROM lineitem"""
)
def derived_difference(spark, sf_dir):
    profit = rules.difference(F.col("l_extendedprice"), F.nullif(F.col("l_tax"), F.lit(0.0)))
    target = rules.number_text(F.col("l_suppkey"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", profit.alias("profit"), target.alias("target")
    )


@query(
    """SELECT n_nationkey, TIMESTAMP '2024-06-01 12:00:00' AS created_at, TIMESTAMP '2024-06-01 12:00:00' AS updated_at
       FROM nation"""
)
def run_timestamp(spark, sf_dir):
    now = rules.run_time("2024-06-01 12:00:00")
    return conform.with_constants(
        table(spark, sf_dir, "nation").select("n_nationkey"), {"created_at": now, "updated_at": now}
    )


@query("SELECT p_partkey, p_type FROM part WHERE NOT starts_with(p_type, 'ECO')")
def prefix_exclude(spark, sf_dir):
    return filters.exclude_prefix(table(spark, sf_dir, "part"), "p_type", "ECO").select("p_partkey", "p_type")


@query(
    """SELECT p_partkey, p_type, p_name FROM part
       WHERE p_type = 'PROMO' AND (starts_with(p_name, 'small') OR starts_with(p_name, 'red'))"""
)
def prefix_or_equality(spark, sf_dir):
    df = filters.equals_and_prefix(table(spark, sf_dir, "part"), "p_type", "PROMO", "p_name", ["small", "red"])
    return df.select("p_partkey", "p_type", "p_name")


@query("SELECT n_nationkey, n_name FROM nation WHERE n_name IN ('NATION_1', 'NATION_3', 'NATION_20')")
def membership(spark, sf_dir):
    df = filters.keep_members(table(spark, sf_dir, "nation"), "n_name", ["NATION_1", "NATION_3", "NATION_20"])
    return df.select("n_nationkey", "n_name")


@query(
    """SELECT c_custkey, segment FROM (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer)
       WHERE segment NOT IN ('MACHINERY', 'FURNITURE')"""
)
def non_membership(spark, sf_dir):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    df = table(spark, sf_dir, "customer").select("c_custkey", segment.alias("segment"))
    return filters.drop_members(df, "segment", ["MACHINERY", "FURNITURE"])


@query("SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer WHERE c_mktsegment <> 'BUILDING'")
def not_null(spark, sf_dir):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    df = table(spark, sf_dir, "customer").select("c_custkey", segment.alias("segment"))
    return filters.not_null(df, "segment")


@query(
    """WITH t AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_name END AS a,
                         nullif(c_mktsegment, 'BUILDING') AS b FROM customer)
       SELECT c_custkey, a, b FROM t WHERE coalesce(nullif(a, ''), nullif(b, '')) IS NOT NULL"""
)
def either_present(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 2 == 0, "").otherwise(F.col("c_name")).alias("a"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("b"),
    )
    return filters.any_present(df, "a", "b")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-30 00:00:00' - INTERVAL 180 DAY")
def recent_cutoff(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return filters.since_days(df, "o_orderdate", dt.datetime(2000, 6, 30))


@query("SELECT event_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'")
def fixed_cutoff(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    return filters.since_date(df, dt.date(2024, 1, 15))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
       WHERE CAST(l_orderkey AS VARCHAR) = '42' AND l_returnflag IS NOT NULL"""
)
def slice_by_key(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return filters.slice_by_key(df, "l_orderkey", "42")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 2 = 1")
def flag_equality(spark, sf_dir):
    odd = (F.col("o_custkey") % 2).cast("boolean")
    return table(spark, sf_dir, "orders").filter((F.col("o_orderstatus") == "F") & odd).select("o_orderkey", "o_orderstatus")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'active' ELSE 'inactive' END AS state,
              CASE WHEN nullif(o_orderstatus, 'P') = 'F' THEN 'yes' ELSE 'no' END AS done FROM orders"""
)
def code_map_two_way(spark, sf_dir):
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        rules.two_way(F.upper(status) == "O", "active", "inactive").alias("state"),
        rules.two_way(F.nullif(status, F.lit("P")) == "F", "yes", "no").alias("done"),
    )


@query(
    """SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'trial' WHEN 1 THEN 'single' WHEN 2 THEN 'double'
              WHEN 3 THEN 'triple' WHEN 4 THEN 'instant' ELSE 'trial' END AS stage,
              CASE nullif(o_orderkey % 3, 2) WHEN 0 THEN 'standard' WHEN 1 THEN 'aggressive' ELSE 'standard' END AS type
       FROM orders"""
)
def code_map_multi(spark, sf_dir):
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        rules.code_map(key % 7, rulebook.ACCOUNT_STAGES, rulebook.DEFAULT_ACCOUNT_STAGE).alias("stage"),
        rules.code_map(F.nullif(key % 3, F.lit(2)), rulebook.ACCOUNT_TYPES, rulebook.DEFAULT_ACCOUNT_TYPE).alias("type"),
    )


@query(
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'view' THEN 'seen'
              ELSE event_type END AS event_type FROM events"""
)
def value_remap(spark, sf_dir):
    changed = rules.remap(F.col("event_type"), {"error": "failed", "view": "seen"})
    return table(spark, sf_dir, "events").select("event_id", changed.alias("event_type"))


@query(
    """SELECT o_orderkey, CASE WHEN contains(o_orderpriority, 'LOW') OR contains(o_orderpriority, 'MED') THEN 2
              WHEN contains(o_orderpriority, 'HIGH') OR contains(o_orderpriority, '3-') THEN 3 ELSE 1 END AS phase
       FROM orders"""
)
def phase_from_text(spark, sf_dir):
    phase = rules.phase_of(F.col("o_orderpriority"), [(("LOW", "MED"), 2), (("HIGH", "3-"), 3)])
    return table(spark, sf_dir, "orders").select("o_orderkey", phase.alias("phase"))


_STATE = """
  p AS (SELECT src_id, action_type, funded_at, is_active,
          CASE WHEN contains("group", '1-A') OR contains("group", '1-B') THEN 1
               WHEN contains("group", '2-A') OR contains("group", '2-B') THEN 2
               WHEN contains("group", '3-A') OR contains("group", '3-B') THEN 3 ELSE 1 END AS phase,
          "group" IN ('demo\\Acme\\U-FTF-1-A', 'demo\\Acme\\U-FTF-1-B') OR
            "group" IN (SELECT funded_group_name FROM in_platform_groups WHERE funded_group_name IS NOT NULL) AS funded
        FROM in_accounts)"""


@query(
    with_inputs(
        ["accounts", "platform_groups"],
        f"""WITH {_STATE}
SELECT src_id,
  CASE WHEN funded_at IS NOT NULL AND funded AND is_active = 1 THEN 0 ELSE phase END AS current_phase,
  CASE WHEN funded_at IS NULL THEN is_active WHEN NOT funded AND is_active = 0 THEN 0 WHEN NOT funded THEN 2
       WHEN funded AND is_active = 1 THEN 1 END AS status,
  CASE WHEN funded_at IS NULL THEN 0 WHEN NOT funded AND is_active = 0 THEN 2 WHEN NOT funded THEN 0
       WHEN funded AND is_active = 1 THEN 1 END AS funded_status,
  CASE WHEN lower(action_type) = 'competition' THEN 'demo\\Acme\\U-COM-1-B'
       WHEN funded_at IS NOT NULL AND funded AND is_active = 1 THEN 'demo\\Acme\\U-FND-1-B'
       ELSE 'demo\\Acme\\U-EVL-1-B' END AS remote_group_name
FROM p""",
    )
)
def funded_state_machine(spark, sf_dir):
    df = with_account_rules(derived(spark, sf_dir, "accounts"), NAMES, derived(spark, sf_dir, "platform_groups"))
    return df.select("src_id", "current_phase", "status", "funded_status", "remote_group_name")


@query(
    """SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate END,
              TIMESTAMP '1994-01-01 00:00:00') AS updated_at,
              coalesce(nullif(CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderstatus END, ''), o_orderpriority) AS label
       FROM orders"""
)
def first_non_null(spark, sf_dir):
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        rules.first_present(
            F.when(key % 3 == 0, F.col("o_orderdate")), F.lit("1994-01-01 00:00:00").cast("timestamp_ntz")
        ).alias("updated_at"),
        rules.first_present(
            F.when(key % 2 == 0, "").otherwise(F.col("o_orderstatus")), F.col("o_orderpriority"), blank=True
        ).alias("label"),
    )


@query(
    """SELECT c_custkey, CASE WHEN nullif(c_mktsegment, 'FURNITURE') = 'BUILDING' THEN 1 ELSE 0 END AS is_building
       FROM customer"""
)
def flag_from_text(spark, sf_dir):
    flag = rules.flag_if(F.nullif(F.col("c_mktsegment"), F.lit("FURNITURE")), "BUILDING")
    return table(spark, sf_dir, "customer").select("c_custkey", flag.alias("is_building"))


@query(
    """SELECT upper(p_name) AS upper_name, lower(p_brand) AS lower_brand,
              p_type = 'PROMO' AND NOT (p_size > 25 OR p_brand = 'Brand#1') AS chosen, p_partkey FROM part"""
)
def text_and_logic(spark, sf_dir):
    chosen = (F.col("p_type") == "PROMO") & ~((F.col("p_size") > 25) | (F.col("p_brand") == "Brand#1"))
    return table(spark, sf_dir, "part").select(
        F.upper("p_name").alias("upper_name"), F.lower("p_brand").alias("lower_brand"), chosen.alias("chosen"), "p_partkey"
    )
