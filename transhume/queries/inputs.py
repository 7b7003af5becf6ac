"""Migration inputs derived from the given tables.

Plain SQL that both engines read alike, so a query and its check start from the same
rows. Each covers the cases the exports distinguish: null, blank and repeated keys,
one key on a third of the rows, unknown references, mixed spellings.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from transhume.queries.registry import once, table

_DAY = "'2024-0{month}-' || lpad(CAST({key} % 28 + 1 AS STRING), 2, '0') || ' 08:30:00'"


def _day(key: str, month: int) -> str:
    return _DAY.format(key=key, month=month)


_B = "chr(92)"
_ACME = f"'demo' || {_B} || 'Acme' || {_B} || 'U-'"

INPUTS: dict[str, str] = {
    "users": f"""
SELECT c_custkey AS id,
  CASE WHEN c_custkey IN (7, 11) THEN 'owner@example.com'
       ELSE 'user' || CAST(c_custkey AS STRING) || '@example.com' END AS username,
  'secret' AS password, 'hash' AS reset_pass_hash, c_name AS firstname, c_mktsegment AS lastname,
  '555' || CAST(c_custkey AS STRING) AS phone, CAST(c_custkey % 2 AS INT) AS phone_verified,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_custkey % 4 AS INT) END AS role,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey % 2 AS INT) END AS active,
  CASE WHEN c_custkey % 3 = 0 THEN 5 WHEN c_custkey % 3 = 1 THEN NULL
       WHEN c_custkey % 10 = 1 THEN c_custkey + 100000000 ELSE c_custkey - 1 END AS ref_by_user_id,
  CAST(c_custkey % 9 AS INT) AS ref_link_clicks, 1 AS sent_activation_mail_count,
  CASE WHEN c_custkey % 4 = 0 THEN '' WHEN c_custkey % 4 = 1 THEN NULL
       ELSE 'street ' || CAST(c_nationkey AS STRING) END AS address,
  CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS country,
  '' AS state, 'town' AS city, CAST(c_nationkey AS STRING) AS zip, 'UTC' AS timezone,
  0 AS `2fa_sms_enabled`,
  CASE WHEN c_custkey % 3 = 0 THEN 'completed' WHEN c_custkey % 3 = 1 THEN '' ELSE 'pending' END AS identity_status,
  CASE WHEN c_custkey % 3 = 0 THEN {_day("c_custkey", 2)} ELSE '' END AS identity_verified_at,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 1 END AS accept_affiliate_terms,
  0 AS dashboard_popup, 1 AS discord_connected,
  {_day("c_custkey", 3)} AS last_login, {_day("c_custkey", 1)} AS created_at
FROM {{customer}}""",
    "discount_codes": f"""
SELECT p_partkey AS id,
  CASE WHEN p_partkey % 40 = 0 THEN NULL
       ELSE p_brand || '-' || p_type || '-' || CAST(p_size % 10 AS STRING) END AS code,
  CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 4 = 0 THEN 'ACTIVE' WHEN p_partkey % 4 = 1 THEN 'Active'
       WHEN p_partkey % 4 = 2 THEN 'INACTIVE' ELSE 'expired' END AS status,
  p_size AS max_usages_count, CAST(p_size % 5 AS INT) AS current_usages_count, p_retailprice / 100 AS discount,
  {_day("p_partkey", 9)} AS discount_code_end_date, p_name AS group_name, '10000' AS account_balance,
  '[1000, 5000]' AS challenge_amount, '["a@example.com"]' AS email, '[1]' AS challenge_step,
  {_day("p_partkey", 1)} AS created_date,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE {_day("p_partkey", 4)} END AS last_modified_date
FROM {{part}}""",
    "purchases": """
SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 10 = 0 THEN o_custkey + 100000000 WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS user_id,
  o_totalprice AS amount_total, 'usd' AS currency,
  CASE WHEN o_orderkey % 2 = 0 THEN 'card' ELSE 'Crypto' END AS payment_method,
  CAST(o_orderkey % 3 AS INT) AS payment_status, 0 AS is_paid_aff_commission, '["x"]' AS user_data,
  o_orderdate AS created_at, o_totalprice AS original_amount,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(99.9 AS DOUBLE) END AS discount,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN 3 ELSE o_orderkey % 2500 END AS discount_id,
  1 AS already_paid, 't' || CAST(o_orderkey AS STRING) AS payment_transaction_id,
  'ok' AS payment_response, 1 AS payment_attempt_count
FROM {orders}""",
    "platform_groups": f"""
SELECT 'g-' || CAST(n_nationkey AS STRING) AS uuid,
  'demo' || {_B} || CASE WHEN n_nationkey % 5 = 4 THEN {_B} ELSE '' END
    || CASE WHEN n_nationkey % 9 = 8 THEN 'Other' ELSE 'Acme' END || {_B} || 'U-DAG-'
    || CAST(n_nationkey % 3 + 1 AS STRING) || '-A' AS name,
  CASE WHEN n_nationkey % 8 = 7 THEN 'competition' ELSE 'challenge' END AS group_type,
  'mt5' AS platform_name,
  CASE n_nationkey % 5 WHEN 0 THEN 'trial' WHEN 1 THEN 'single' WHEN 2 THEN 'double' WHEN 3 THEN 'triple'
       ELSE 'instant' END AS account_stage,
  CASE WHEN n_nationkey % 10 < 5 THEN 'standard' ELSE 'aggressive' END AS account_type,
  CAST(10000 * ((n_nationkey - n_nationkey % 5) / 5 + 1) AS DOUBLE) AS initial_balance,
  CASE WHEN n_nationkey % 6 = 5 THEN NULL
       ELSE {_ACME} || 'X' || CAST(n_nationkey % 4 AS STRING) || '-1-A' END AS funded_group_name
FROM {{nation}}""",
    "accounts": f"""
SELECT o_orderkey AS src_id,
  CASE WHEN o_orderkey % 17 = 0 THEN 'D#' || CAST(o_orderkey AS STRING) WHEN o_orderkey % 19 = 0 THEN NULL
       ELSE CAST(500000 + o_orderkey - CASE WHEN o_orderkey % 13 = 1 THEN 1 ELSE 0 END AS STRING) END AS login,
  CASE WHEN o_orderkey % 10 = 0 THEN o_custkey + 100000000 ELSE o_custkey END AS user_id,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey - o_orderkey % 4 END AS purchase_id,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN ''
       ELSE {_ACME} || CASE o_custkey % 5 WHEN 0 THEN 'DAG-1-B' WHEN 1 THEN 'SAG-2-A' WHEN 2 THEN 'FTF-1-A'
            WHEN 3 THEN 'X1-1-A' ELSE 'DST-3-B' END END AS `group`,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS funded_at,
  CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE CAST(o_custkey % 2 AS INT) END AS is_active,
  CASE WHEN o_custkey % 12 = 0 THEN 'Competition' ELSE 'challenge' END AS action_type,
  CAST(10000 * (o_custkey % 6 + 1) AS BIGINT) AS initial_balance, o_totalprice AS target,
  CAST(80 AS DOUBLE) AS profit_split, CAST(10 AS DOUBLE) AS max_drawdown, CAST(5 AS DOUBLE) AS max_daily_drawdown,
  CASE WHEN o_custkey % 7 = 0 THEN 9 ELSE CAST(o_custkey % 6 % 2 AS INT) END AS account_type,
  CAST((o_custkey + o_orderkey) % 6 AS INT) AS account_stages, 100 AS account_leverage,
  CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE 1 END AS trades_check,
  CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE 0 END AS contract_sign_staus,
  CASE WHEN o_custkey % 8 = 0 THEN 'breach' END AS reason, o_orderdate AS created_at
FROM {{orders}}""",
    "preferred_logins": """
SELECT CAST(500000 + o_orderkey AS STRING) AS login, o_orderkey - o_orderkey % 4 AS purchase_id
FROM {orders} WHERE o_orderstatus = 'P'""",
    "account_data": """
SELECT CAST(500000 + o_orderkey AS STRING) AS account_login, 'm' || CAST(o_custkey AS STRING) AS main_password,
  'i' || CAST(o_custkey AS STRING) AS investor_password
FROM {orders} WHERE o_orderpriority <> '5-LOW'""",
    "account_stats": f"""
SELECT o_orderkey AS src_id,
  CAST(500000 + o_orderkey - CASE WHEN o_orderkey % 29 = 1 THEN 1 ELSE 0 END AS STRING) AS account_login,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 6 = 1 THEN '' ELSE {_ACME} || 'DAG-2-B' END AS `group`,
  CAST(o_orderkey % 2 AS INT) AS status, o_totalprice AS current_equity,
  CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_totalprice / 2 END AS yesterday_equity,
  CAST(1 AS DOUBLE) AS performance_percent, CAST(2 AS DOUBLE) AS current_overall_drawdown,
  CAST(3 AS DOUBLE) AS current_daily_drawdown, CAST(4 AS DOUBLE) AS average_win, CAST(5 AS DOUBLE) AS average_loss,
  CAST(6 AS DOUBLE) AS hit_ratio, CAST(7 AS DOUBLE) AS best_trade, CAST(8 AS DOUBLE) AS worst_trade,
  1 AS max_consecutive_wins, 2 AS max_consecutive_losses, 3 AS trades_without_stoploss,
  o_orderpriority AS most_traded_asset, CAST(9 AS DOUBLE) AS win_coefficient,
  CAST(10 AS DOUBLE) AS avg_win_loss_coefficient, CAST(11 AS DOUBLE) AS best_worst_coefficient,
  CAST(12 AS DOUBLE) AS maximum_daily_drawdown, CAST(13 AS DOUBLE) AS maximum_overall_drawdown,
  CAST(14 AS DOUBLE) AS consistency_score
FROM {{orders}}""",
    "platform_events": """
SELECT event_id AS id, user_id,
  CASE WHEN event_id % 3 = 0 THEN '500004' WHEN event_id % 10 = 1 THEN NULL
       WHEN event_id % 10 = 2 THEN '0' || CAST(500000 + event_id AS STRING)
       ELSE CAST(500000 + event_id AS STRING) END AS login,
  CASE WHEN event_type = 'error' THEN 'hardBreach' WHEN event_type = 'view' THEN NULL ELSE event_type END AS event,
  CAST(date_trunc('second', ts) AS STRING) AS created_at, 0 AS hourl_gap_status
FROM {events}""",
    "breach_activities": """
SELECT event_id AS `Id`,
  CASE WHEN event_id % 3 = 0 THEN '500004' ELSE CAST(500000 + event_id AS STRING) END AS account_login,
  CAST(event_id % 7 AS INT) AS `BreachCount`,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(date_trunc('second', ts) AS STRING) END AS `LastBreachDate`,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id % 4 AS INT) END AS `IsBreached`
FROM {events}""",
    "payout_requests": """
SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 10 = 0 THEN o_custkey + 100000000 WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS user_id,
  CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE CAST(500000 + o_orderkey AS STRING) END AS program_login,
  CASE WHEN o_orderkey % 3 = 0 THEN 'affiliate' WHEN o_orderkey % 3 = 1 THEN 'challenge' END AS type,
  o_totalprice AS amount, 'bank' AS method,
  CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE CAST(o_orderkey % 6 AS INT) END AS status, '[]' AS data,
  CASE WHEN o_orderkey % 5 = 0 THEN 'note ' || CAST(o_orderkey AS STRING) END AS compliance_note,
  'nobody' AS approved_by, o_orderdate AS created_at, o_orderdate AS updated_at
FROM {orders}""",
    "equity_daily": """
SELECT CASE WHEN l_partkey % 3 = 0 THEN '500004' WHEN l_partkey % 20 = 1 THEN NULL
       ELSE CAST(500000 + l_orderkey AS STRING) END AS trading_account,
  CAST(CAST(l_shipdate AS DATE) AS STRING) AS day, CAST(l_shipdate AS STRING) AS created_date,
  l_extendedprice AS equity, l_quantity AS balance, CAST(l_linenumber AS INT) AS equity_eod_mt5,
  l_orderkey, l_partkey, l_suppkey, l_linenumber
FROM {lineitem}""",
    "deals": """
SELECT CASE WHEN l_partkey % 3 = 0 THEN '500004' WHEN l_partkey % 20 = 1 THEN NULL
       ELSE CAST(500000 + l_orderkey AS STRING) END AS trading_account,
  l_orderkey * 10 + l_linenumber AS deal_id, l_partkey AS position_id, CAST(l_linenumber % 2 AS INT) AS deal_type,
  l_extendedprice AS profit, CAST(l_shipdate AS STRING) AS deal_time, 1 AS deal_entry, l_tax AS deal_price,
  l_returnflag AS deal_symbol, l_discount AS deal_stoploss, CAST(l_quantity AS INT) AS deal_volume,
  l_tax AS deal_commission, CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE CAST(l_suppkey % 3 AS INT) END AS dupe_detected,
  CAST(l_linenumber AS INT) AS deal_swap
FROM {lineitem}""",
    "default_settings": """
SELECT 't' || CAST(r_regionkey AS STRING) AS uuid, r_regionkey = 0 AS `100_profit_split`,
  r_regionkey = 1 AS `2_percent_lower_target`, false AS `2_percent_more_daily_drawdown`,
  r_name = 'AFRICA' AS allow_expert_advisors, r_name AS breach_type, r_regionkey + 30 AS delete_account_after_failure,
  'days' AS delete_account_after_failure_unit, true AS requires_stop_loss, 5 AS min_trading_days,
  100 AS account_leverage, CAST(r_regionkey + 8 AS INT) AS profit_target, CAST(80 AS DOUBLE) AS profit_split,
  CAST(NULL AS DOUBLE) AS max_open_lots, 'someone' AS updated_by, r_name AS remark
FROM {region}""",
    "role_permissions": """
SELECT s_suppkey AS id, CASE s_suppkey % 5 WHEN 0 THEN '4498cf39-7fe2-4059-9571-6e65632eb283'
       WHEN 1 THEN '6385517c-60e2-4866-873d-7859a28c2de3' WHEN 2 THEN 'f00e01b9-ffaa-49c6-b680-7348ef7797a4'
       WHEN 3 THEN 'other' END AS role_uuid, s_name AS permission
FROM {supplier}""",
}

_TABLE = re.compile(r"\{(\w+)\}")


@once
def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A migration input as a DataFrame over the given tables."""
    text = INPUTS[name]
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in _TABLE.findall(text)})


def derived_sql(name: str) -> str:
    """The same input as SQL for the check."""
    return _TABLE.sub(r"\1", INPUTS[name]).replace("`", '"').strip()


def with_inputs(names: list[str], sql: str) -> str:
    """Put inputs as common table expressions ``in_<name>`` before a query."""
    parts = ",\n".join(f"in_{n} AS ({derived_sql(n)})" for n in names)
    head, rest = ("WITH " + parts, sql.strip())
    return f"{head},\n{rest[4:].lstrip()}" if rest[:5].upper() == "WITH " else f"{head}\n{rest}"
