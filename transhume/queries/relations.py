"""Lookups, dedup, set operations and audit aggregates over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from transhume.functions.text import text_of
from transhume.operators import audit, dedup, lookup
from transhume.plans.audits import coverage
from transhume.queries.inputs import derived, with_inputs
from transhume.queries.registry import query, table, uuid_sql
from transhume.functions.keys import uuid_from


def _building(spark, sf_dir):
    """Customers of one segment: a lookup table in which most keys are missing."""
    rows = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return rows.withColumn("uuid", uuid_from("customer", "c_custkey"))


_BUILDING = f"""
  dim AS (SELECT c_custkey, c_name, {uuid_sql('customer', 'c_custkey')} AS uuid FROM customer
          WHERE c_mktsegment = 'BUILDING')"""


@query(f"WITH {_BUILDING} SELECT o_orderkey, uuid AS user_uuid FROM orders LEFT JOIN dim ON o_custkey = c_custkey")
def lookup_left(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    found = lookup.lookup(
        orders, _building(spark, sf_dir), "o_custkey", "c_custkey", {"user_uuid": "uuid"}, unique=True
    )
    return found.drop("o_custkey")


@query(
    f"""WITH {_BUILDING}
SELECT event_id, c_name AS user_name FROM events LEFT JOIN dim ON CAST(user_id AS VARCHAR) = CAST(c_custkey AS VARCHAR)"""
)
def lookup_text_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    found = lookup.lookup(
        events, _building(spark, sf_dir), "user_id", "c_custkey", {"user_name": "c_name"}, text=True, unique=True
    )
    return found.drop("user_id")


@query(
    """SELECT l_orderkey, l_linenumber, l_suppkey, p_brand AS brand, p_type AS type
       FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size < 25) ON l_partkey = p_partkey"""
)
def lookup_multi_attr(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    parts = table(spark, sf_dir, "part").filter(F.col("p_size") < 25)
    taken = {"brand": "p_brand", "type": "p_type"}
    return lookup.lookup(lines, parts, "l_partkey", "p_partkey", taken, unique=True).drop("l_partkey")


@query(
    """WITH dim AS (SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS last_priority FROM orders GROUP BY 1)
       SELECT c_custkey, last_priority FROM customer LEFT JOIN dim ON c_custkey = o_custkey"""
)
def lookup_last_wins(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    orders = table(spark, sf_dir, "orders")
    return lookup.lookup(
        customers, orders, "c_custkey", "o_custkey", {"last_priority": "o_orderpriority"}, last_by=["o_orderkey"]
    )


@query(
    """SELECT a.c_custkey, b.c_name AS ref_name FROM customer a
       LEFT JOIN customer b ON a.c_custkey - a.c_custkey % 3 - 3 = b.c_custkey"""
)
def lookup_self(spark, sf_dir):
    key = F.col("c_custkey")
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_name", (key - key % 3 - 3).alias("ref"))
    return lookup.lookup_self(df, "ref", "c_custkey", {"ref_name": "c_name"}).select("c_custkey", "ref_name")


@query(
    """WITH hop AS (SELECT doc_id, CASE WHEN doc_id % 20 = 0 THEN NULL ELSE text END AS body FROM documents),
            kept AS (SELECT body, min(doc_id) AS first_id FROM hop GROUP BY body)
       SELECT l.doc_id, kept.first_id AS surviving_id FROM labels l
       LEFT JOIN hop ON l.doc_id = hop.doc_id LEFT JOIN kept ON hop.body IS NOT DISTINCT FROM kept.body"""
)
def lookup_two_hop(spark, sf_dir):
    body = F.when(F.col("doc_id") % 20 != 0, F.col("text"))
    hops = table(spark, sf_dir, "documents").select("doc_id", body.alias("body"))
    kept = dedup.keep_first(hops, ["body"], ["doc_id"], wide=["body"])
    labels = table(spark, sf_dir, "labels").select("doc_id")
    return lookup.lookup_two_hop(
        labels, hops, kept, "doc_id", "doc_id", "body", "body", {"surviving_id": "doc_id"}, wide=True
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, o_orderpriority AS priority
       FROM lineitem JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') ON l_orderkey = o_orderkey"""
)
def orphan_drop(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return lookup.lookup(
        lines, orders, "l_orderkey", "o_orderkey", {"priority": "o_orderpriority"}, unique=True, inner=True
    )


_HOT = "CASE WHEN l_partkey % 3 = 0 THEN 4 WHEN l_partkey % 7 = 0 THEN NULL ELSE l_orderkey END"


@query(
    f"""WITH l AS (SELECT {_HOT} AS k, l_linenumber, l_partkey, l_suppkey FROM lineitem)
        SELECT k, l_linenumber, l_partkey, l_suppkey, o_orderpriority AS priority
        FROM l LEFT JOIN orders ON k = o_orderkey"""
)
def lookup_hot_key(spark, sf_dir):
    part = F.col("l_partkey")
    key = F.when(part % 3 == 0, 4).when(part % 7 != 0, F.col("l_orderkey"))
    lines = table(spark, sf_dir, "lineitem").select(key.cast("long").alias("k"), "l_linenumber", "l_partkey", "l_suppkey")
    return lookup.lookup(
        lines,
        table(spark, sf_dir, "orders"),
        "k",
        "o_orderkey",
        {"priority": "o_orderpriority"},
        unique=True,
        salt_hot=F.struct("l_partkey", "l_suppkey"),
        hot_rows=1000,
    )


@query(
    """WITH combos AS (SELECT p_brand, p_type, p_size, min(p_partkey) AS combo_id FROM part
                       WHERE p_size < 20 GROUP BY ALL)
       SELECT part.p_partkey, part.p_brand, part.p_type, part.p_size, combo_id
       FROM part JOIN combos USING (p_brand, p_type, p_size)"""
)
def composite_join(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    keys = ["p_brand", "p_type", "p_size"]
    combos = part.filter(F.col("p_size") < 20).groupBy(*keys).agg(F.min("p_partkey").alias("id"))
    joined = lookup.composite_join(part.select("p_partkey", *keys), combos, keys, {"combo_id": "id"})
    return joined.select("p_partkey", *keys, "combo_id")


@query(
    """SELECT p_brand, p_type, p_size, count(*) AS rows FROM part GROUP BY ALL HAVING count(*) > 1"""
)
def repeated_keys(spark, sf_dir):
    return lookup.repeated_keys(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size"])


_PREF = """
  pref AS (SELECT purchase_id, max(login) AS login FROM in_preferred_logins GROUP BY 1),
  flagged AS (SELECT a.*, p.login IS NOT NULL AS is_preferred FROM in_accounts a
              LEFT JOIN pref p ON a.purchase_id = p.purchase_id AND a.login = p.login)"""


@query(
    with_inputs(
        ["accounts", "preferred_logins"],
        f"WITH {_PREF} SELECT src_id, login, purchase_id, is_preferred FROM flagged",
    )
)
def preference_flag(spark, sf_dir):
    accounts = derived(spark, sf_dir, "accounts").select("src_id", "login", "purchase_id")
    prefs = derived(spark, sf_dir, "preferred_logins")
    return dedup.flag_preferred(accounts, prefs, "purchase_id", "login", "is_preferred")


@query(
    with_inputs(
        ["accounts", "preferred_logins"],
        f"""WITH {_PREF}
SELECT src_id, login, purchase_id FROM (
  SELECT *, row_number() OVER (PARTITION BY purchase_id ORDER BY CASE WHEN is_preferred THEN 0 ELSE 1 END, src_id) AS rn
  FROM flagged) WHERE rn = 1""",
    )
)
def preferred_dedup(spark, sf_dir):
    accounts = derived(spark, sf_dir, "accounts").select("src_id", "login", "purchase_id")
    prefs = derived(spark, sf_dir, "preferred_logins")
    df = dedup.flag_preferred(accounts, prefs, "purchase_id", "login", "is_preferred")
    return dedup.keep_preferred(df, ["purchase_id"], ["src_id"], F.col("is_preferred")).drop("is_preferred")


@query(
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')"""
)
def anti_by_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lookup.missing_from(orders, _building(spark, sf_dir), "o_custkey", "c_custkey")


@query(
    """SELECT s_suppkey, (SELECT min(n_nationkey) FROM nation WHERE n_regionkey = 2) AS created_by,
              (SELECT n_name FROM nation WHERE n_name = 'NOWHERE') AS updated_by FROM supplier"""
)
def scalar_lookup(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    first = lookup.first_value(nation, F.col("n_regionkey") == 2, "n_nationkey", "n_nationkey")
    none = lookup.first_value(nation, F.col("n_name") == "NOWHERE", "n_name", "n_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey")
    return suppliers.withColumns({"created_by": first, "updated_by": none})


@query(
    """SELECT n_nationkey AS nation_key, CAST(NULL AS BIGINT) AS customer_key, t.r_name, CAST(t.r_regionkey AS VARCHAR) AS r_regionkey
       FROM nation, (SELECT * FROM region ORDER BY r_regionkey LIMIT 1) t
       UNION ALL
       SELECT NULL, c_custkey, t.r_name, CAST(t.r_regionkey AS VARCHAR)
       FROM customer, (SELECT * FROM region ORDER BY r_regionkey LIMIT 1) t"""
)
def template_rows(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation_key"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_key"))
    owners = nations.unionByName(customers, allowMissingColumns=True)
    copied = lookup.with_template(owners, table(spark, sf_dir, "region"), ["r_name", "r_regionkey"], "r_regionkey")
    return copied.withColumn("r_regionkey", text_of(F.col("r_regionkey")))


@query(
    """SELECT count(*) AS total, count(*) FILTER (EXISTS (SELECT 1 FROM customer
              WHERE c_custkey = user_id AND c_mktsegment = 'BUILDING')) AS with_partner,
              count(*) FILTER (NOT EXISTS (SELECT 1 FROM customer
              WHERE c_custkey = user_id AND c_mktsegment = 'BUILDING')) AS without_partner FROM events"""
)
def coverage_semi(spark, sf_dir):
    return coverage(table(spark, sf_dir, "events"), "user_id", _building(spark, sf_dir), "c_custkey")


@query(
    """SELECT event_id, user_id FROM events
       WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id AND c_mktsegment = 'BUILDING')"""
)
def semi_join(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return lookup.exists_in(events, _building(spark, sf_dir), "user_id", "c_custkey")


@query("SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def frequency(spark, sf_dir):
    return audit.frequency(table(spark, sf_dir, "events"), "event_type")


@query(
    """WITH t AS (SELECT CASE WHEN doc_id % 20 = 0 THEN NULL ELSE text END AS body FROM documents)
       SELECT count(*) AS total, count(DISTINCT body) + CAST(max(CASE WHEN body IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS distinct_keys,
              count(*) - count(DISTINCT body) - CAST(max(CASE WHEN body IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS duplicates FROM t"""
)
def duplicate_count(spark, sf_dir):
    body = F.when(F.col("doc_id") % 20 != 0, F.col("text"))
    return audit.duplicate_counts(table(spark, sf_dir, "documents").select(body.alias("body")), ["body"], wide=["body"])


@query(
    f"""WITH {_BUILDING}
SELECT count(*) AS total, count(uuid) AS uuid_matched, count(c_name) AS c_name_matched,
  count(*) - count(uuid) AS uuid_unmatched, count(*) - count(c_name) AS c_name_unmatched
FROM orders LEFT JOIN dim ON o_custkey = c_custkey"""
)
def match_counts(spark, sf_dir):
    taken = {"uuid": "uuid", "c_name": "c_name"}
    orders = table(spark, sf_dir, "orders").select("o_custkey")
    found = lookup.lookup(orders, _building(spark, sf_dir), "o_custkey", "c_custkey", taken, unique=True)
    return audit.match_counts(found, "uuid", "c_name")


@query(
    f"""WITH {_BUILDING}
SELECT count(*) AS total, count(uuid) AS matched, round(100.0 * count(uuid) / count(*), 1) AS match_rate
FROM orders LEFT JOIN dim ON o_custkey = c_custkey"""
)
def match_rate(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey")
    found = lookup.lookup(orders, _building(spark, sf_dir), "o_custkey", "c_custkey", {"uuid": "uuid"}, unique=True)
    return audit.match_rate(found, "uuid")


@query(
    """SELECT count(*) FILTER (a IS NOT NULL) AS from_primary, count(*) FILTER (a IS NULL AND b IS NOT NULL) AS from_backup,
              count(*) FILTER (a IS NULL AND b IS NULL) AS from_none
       FROM (SELECT nullif(c_mktsegment, 'BUILDING') AS a, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS b FROM customer)"""
)
def source_precedence(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select(
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("a"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("b"),
    )
    return audit.precedence_counts(df, "a", "b")


@query(
    """SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS finished,
              count(*) FILTER (o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F') AS waiting FROM orders"""
)
def flag_counts(spark, sf_dir):
    finished = F.col("o_orderstatus") == "F"
    waiting = (F.col("o_orderpriority") == "1-URGENT") & ~finished
    return audit.flag_counts(table(spark, sf_dir, "orders"), {"finished": finished, "waiting": waiting})


@query(
    """SELECT count(*) AS original_records, count(*) FILTER (o_orderstatus = 'F') AS final_records,
              count(*) FILTER (o_orderstatus <> 'F') AS total_removed,
              round(100.0 * count(*) FILTER (o_orderstatus = 'F') / count(*), 2) AS retention_rate FROM orders"""
)
def retention_rate(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return audit.retention(orders, orders.filter(F.col("o_orderstatus") == "F"))


@query(
    """WITH c AS (SELECT count(*) AS n0, count(*) FILTER (l_returnflag <> 'N') AS n1,
         count(*) FILTER (l_returnflag <> 'N' AND l_quantity >= 10) AS n2,
         count(*) FILTER (l_returnflag <> 'N' AND l_quantity >= 10 AND l_discount < 0.05) AS n3,
         count(*) FILTER (l_returnflag <> 'N' AND l_quantity >= 10 AND l_discount < 0.05
                          AND l_shipdate >= TIMESTAMP '1998-01-01 00:00:00') AS n4 FROM lineitem)
       SELECT 1 AS step_no, 'Returned' AS step_name, n0 AS records_before, n1 AS records_after, n0 - n1 AS records_removed, 'flag' AS reason FROM c
       UNION ALL SELECT 2, 'Large', n1, n2, n1 - n2, 'quantity' FROM c
       UNION ALL SELECT 3, 'Cheap', n2, n3, n2 - n3, 'discount' FROM c
       UNION ALL SELECT 4, 'Late', n3, n4, n3 - n4, 'date' FROM c"""
)
def step_funnel(spark, sf_dir):
    steps = [
        ("Returned", "flag", F.col("l_returnflag") != "N"),
        ("Large", "quantity", F.col("l_quantity") >= 10),
        ("Cheap", "discount", F.col("l_discount") < 0.05),
        ("Late", "date", F.col("l_shipdate") >= F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")),
    ]
    return audit.step_funnel(table(spark, sf_dir, "lineitem"), steps).drop("details")


@query(
    """WITH p AS (SELECT 'o_orderstatus' AS measure, o_orderstatus AS value FROM orders
                  UNION ALL SELECT 'o_orderpriority', nullif(o_orderpriority, '5-LOW') FROM orders)
       SELECT measure, value, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM orders), 2) AS percentage
       FROM p GROUP BY measure, value"""
)
def distribution(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderstatus", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority")
    )
    return audit.distribution(orders, ["o_orderstatus", "o_orderpriority"])


@query(
    """SELECT doc_id, lang, source, n_chars FROM (
         SELECT *, row_number() OVER (PARTITION BY CASE WHEN doc_id % 20 = 0 THEN NULL ELSE text END ORDER BY doc_id) AS rn
         FROM documents) WHERE rn = 1"""
)
def keep_first(spark, sf_dir):
    body = F.when(F.col("doc_id") % 20 != 0, F.col("text"))
    docs = table(spark, sf_dir, "documents").withColumn("body", body)
    return dedup.keep_first(docs, ["body"], ["doc_id"], wide=["body"]).select("doc_id", "lang", "source", "n_chars")


_NULL_KEYED = "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS k FROM orders"


@query(
    f"""WITH t AS ({_NULL_KEYED}), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY o_orderkey) AS rn FROM t)
        SELECT o_orderkey, k, 'keep' AS mode FROM r WHERE k IS NULL OR rn = 1
        UNION ALL SELECT o_orderkey, k, 'drop' FROM r WHERE k IS NOT NULL AND rn = 1
        UNION ALL SELECT o_orderkey, k, 'collapse' FROM r WHERE rn = 1"""
)
def dedup_null_keys(spark, sf_dir):
    key = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey"))
    df = table(spark, sf_dir, "orders").select("o_orderkey", key.alias("k"))
    modes = [
        dedup.keep_first(df, ["k"], ["o_orderkey"], null_keys=m).withColumn("mode", F.lit(m))
        for m in (dedup.KEEP, dedup.DROP, dedup.COLLAPSE)
    ]
    return modes[0].unionByName(modes[1]).unionByName(modes[2])


@query("SELECT DISTINCT p_brand, p_type, p_size FROM part")
def distinct_combos(spark, sf_dir):
    return dedup.distinct_rows(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size"])


@query("SELECT DISTINCT p_brand, p_type FROM part ORDER BY p_brand, p_type")
def sorted_combos(spark, sf_dir):
    return dedup.sorted_distinct(table(spark, sf_dir, "part"), ["p_brand", "p_type"])


@query(
    """SELECT DISTINCT o_custkey FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
       ORDER BY o_custkey LIMIT 10"""
)
def unmatched_sample(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey")
    found = lookup.lookup(orders, _building(spark, sf_dir), "o_custkey", "c_custkey", {"uuid": "uuid"}, unique=True)
    return audit.unmatched_samples(found, "o_custkey", "uuid", 10)


@query(
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier"""
)
def union_rows(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query(
    """WITH listed AS (SELECT 'NATION_2' AS n UNION SELECT 'NATION_9' UNION SELECT n_name FROM nation WHERE n_regionkey = 1)
       SELECT c_custkey, n_name, n_name IN (SELECT n FROM listed) AS listed
       FROM customer JOIN nation ON c_nationkey = n_nationkey"""
)
def merged_list_flag(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    named = lookup.lookup(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
        nation,
        "c_nationkey",
        "n_nationkey",
        {"n_name": "n_name"},
        unique=True,
        inner=True,
    ).drop("c_nationkey")
    dynamic = nation.filter(F.col("n_regionkey") == 1)
    return lookup.flag_member(named, "n_name", dynamic, "n_name", ["NATION_2", "NATION_9"], "listed")
