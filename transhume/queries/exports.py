"""The exports over inputs derived from the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transhume import rulebook
from transhume.operators import audit
from transhume.plans import accounts as acc
from transhume.plans import audits, everything, facts, people, sales
from transhume.queries.columns import NAMES
from transhume.queries.inputs import INPUTS, derived, with_inputs
from transhume.queries.registry import code_sql, once, query, uuid_sql
from transhume.session import stage, stage_path

OWNER = "owner@example.com"
PREFIXES = ["demo\\Acme", "demo\\\\Acme"]
AS_OF = dt.datetime(2001, 12, 31)
DEAL_KEYS = ("deal_id", "position_id")
EQUITY_KEYS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
STATS_KEYS = ("src_id",)


# -- shared tables ---------------------------------------------------------------


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people.user_keys(derived(spark, sf_dir, "users"))


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acc.export_platform_groups(derived(spark, sf_dir, "platform_groups"), PREFIXES)


def _accounts(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return acc.export_platform_accounts(
        derived(spark, sf_dir, "accounts"),
        NAMES,
        user_keys=_keys(spark, sf_dir),
        purchase_keys=sales.purchase_keys(derived(spark, sf_dir, "purchases")),
        stats=derived(spark, sf_dir, "account_stats"),
        preferences=derived(spark, sf_dir, "preferred_logins"),
        account_data=derived(spark, sf_dir, "account_data"),
        groups=_groups(spark, sf_dir),
        order_by=("src_id",),
        stats_last_by=("src_id",),
        **options,
    )


@once
def _exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported accounts, written once and read by all that refers to them."""
    return stage(_accounts(spark, sf_dir), "platform_accounts")


_USER_KEYS = f"user_keys AS (SELECT id, username, identity_status, {uuid_sql('users', 'id')} AS uuid FROM in_users)"
_OWNER = f"(SELECT uuid FROM user_keys WHERE username = '{OWNER}' ORDER BY id LIMIT 1)"
_GROUPS = """groups AS (SELECT * REPLACE (upper(platform_name) AS platform_name) FROM in_platform_groups
  WHERE group_type = 'challenge' AND (starts_with(name, 'demo\\Acme') OR starts_with(name, 'demo\\\\Acme')))"""

_SURVIVORS = """
  own AS (SELECT * FROM in_accounts WHERE NOT starts_with(login, 'D#')),
  pref AS (SELECT purchase_id, max(login) AS login FROM in_preferred_logins GROUP BY 1),
  flagged AS (SELECT a.*, CASE WHEN p.login IS NOT NULL THEN 0 ELSE 1 END AS pref_rank FROM own a
              LEFT JOIN pref p ON a.purchase_id = p.purchase_id AND a.login = p.login),
  by_purchase AS (SELECT * FROM flagged
                  QUALIFY row_number() OVER (PARTITION BY purchase_id ORDER BY pref_rank, src_id) = 1),
  by_login AS (SELECT * FROM by_purchase
               QUALIFY row_number() OVER (PARTITION BY login ORDER BY pref_rank, src_id) = 1),
  known AS (SELECT account_login, arg_max("group", src_id) AS stats_group FROM in_account_stats
            WHERE "group" <> '' GROUP BY 1),
  grouped AS (SELECT b.* REPLACE (coalesce(nullif(b."group", ''), stats_group) AS "group") FROM by_login b
              LEFT JOIN known ON login = account_login)"""

_ACCOUNT_INPUTS = ["users", "accounts", "purchases", "account_stats", "preferred_logins", "account_data", "platform_groups"]

_ACCOUNTS = f"""
  {_USER_KEYS},
  {_GROUPS},
  {_SURVIVORS},
  ruled AS (SELECT *,
      CASE WHEN contains("group", '1-A') OR contains("group", '1-B') THEN 1
           WHEN contains("group", '2-A') OR contains("group", '2-B') THEN 2
           WHEN contains("group", '3-A') OR contains("group", '3-B') THEN 3 ELSE 1 END AS phase,
      ("group" IN ('demo\\Acme\\U-FTF-1-A', 'demo\\Acme\\U-FTF-1-B')
       OR "group" IN (SELECT funded_group_name FROM groups WHERE funded_group_name IS NOT NULL)) AS funded
    FROM grouped WHERE "group" IS NOT NULL),
  exported AS (SELECT {uuid_sql('platform_accounts', 'r.login')} AS uuid, u.uuid AS user_uuid,
      CASE WHEN p.id IS NOT NULL THEN {uuid_sql('purchases', 'p.id')} END AS purchase_uuid,
      r.login AS platform_login_id, g.platform_name,
      CASE WHEN lower(action_type) = 'competition' THEN 'demo\\Acme\\U-COM-1-B'
           WHEN funded_at IS NOT NULL AND funded AND is_active = 1 THEN 'demo\\Acme\\U-FND-1-B'
           ELSE 'demo\\Acme\\U-EVL-1-B' END AS remote_group_name,
      g.uuid AS platform_group_uuid,
      CASE WHEN funded_at IS NOT NULL AND funded AND is_active = 1 THEN 0 ELSE phase END AS current_phase,
      d.main_password, d.investor_password, r.initial_balance, target AS profit_target, profit_split, max_drawdown,
      max_daily_drawdown, g.account_stage, g.account_type, account_leverage,
      CASE WHEN funded_at IS NULL THEN is_active WHEN NOT funded AND is_active = 0 THEN 0 WHEN NOT funded THEN 2
           WHEN funded AND is_active = 1 THEN 1 END AS status,
      funded_at, CASE WHEN u.identity_status = 'completed' THEN 1 ELSE 0 END AS is_kyc,
      coalesce(trades_check, 0) AS is_trades_check, coalesce(contract_sign_staus, 0) AS is_trade_agreement,
      reason, CAST(NULL AS VARCHAR) AS deleted_at, r.created_at, coalesce(funded_at, r.created_at) AS updated_at,
      'challenge' AS action_type,
      CASE WHEN funded_at IS NULL THEN 0 WHEN NOT funded AND is_active = 0 THEN 2 WHEN NOT funded THEN 0
           WHEN funded AND is_active = 1 THEN 1 END AS funded_status,
      CAST(NULL AS VARCHAR) AS platform_user_id
    FROM ruled r
    LEFT JOIN user_keys u ON r.user_id = u.id
    LEFT JOIN in_purchases p ON r.purchase_id = p.id
    LEFT JOIN in_account_data d ON r.login = d.account_login
    JOIN groups g ON g.platform_name = 'MT5'
      AND g.account_stage = CASE account_stages WHEN 1 THEN 'single' WHEN 2 THEN 'double' WHEN 3 THEN 'triple'
                            WHEN 4 THEN 'instant' ELSE 'trial' END
      AND g.account_type = CASE WHEN r.account_type = 1 THEN 'aggressive' ELSE 'standard' END
      AND CAST(g.initial_balance AS BIGINT) = r.initial_balance)"""


def _over_accounts(inputs: list[str], sql: str) -> str:
    return with_inputs(_ACCOUNT_INPUTS + inputs, f"WITH {_ACCOUNTS} {sql}")


# -- entities ----------------------------------------------------------------------

_USERS_SQL = f"""WITH {_USER_KEYS}
SELECT {uuid_sql('users', 'u.id')} AS uuid, ref.uuid AS ref_by_user_id, ref_link_clicks AS ref_link_count,
  u.username AS email, CAST(NULL AS VARCHAR) AS password, firstname AS first_name, lastname AS last_name, phone,
  phone_verified, sent_activation_mail_count, CASE WHEN active = 1 THEN 1 ELSE 0 END AS status,
  CAST(NULL AS VARCHAR) AS reset_pass_hash, nullif(address, '') AS address, nullif(country, '') AS country,
  nullif(state, '') AS state, city, zip, timezone, CAST(NULL AS VARCHAR) AS google_app_secret, "2fa_sms_enabled",
  nullif(u.identity_status, '') AS identity_status, nullif(identity_verified_at, '') AS identity_verified_at,
  accept_affiliate_terms AS affiliate_terms, dashboard_popup, discord_connected, 0 AS used_free_count,
  0 AS available_count, 0 AS trail_verification_status, last_login AS last_login_at, created_at,
  created_at AS updated_at, 0 AS is_google_app_verify, CAST(NULL AS VARCHAR) AS dob,
  CASE WHEN role = 2 THEN '{rulebook.USER_ROLE_ID}' ELSE '{rulebook.ADMIN_ROLE_ID}' END AS role_id,
  accept_affiliate_terms, CAST(NULL AS VARCHAR) AS deleted_at, {code_sql('ref_code', 'u.id')} AS ref_code
FROM in_users u LEFT JOIN user_keys ref ON u.ref_by_user_id = ref.id"""


@query(with_inputs(["users"], _USERS_SQL))
def export_users(spark, sf_dir):
    return people.export_users(derived(spark, sf_dir, "users"))


_CODES = f"""codes AS (SELECT *, {uuid_sql('discount_codes', 'id')} AS uuid FROM in_discount_codes
  QUALIFY row_number() OVER (PARTITION BY code ORDER BY id) = 1)"""


@query(
    with_inputs(
        ["users", "discount_codes"],
        f"""WITH {_USER_KEYS}, {_CODES}
SELECT uuid, code AS name, code, max_usages_count AS max_usage_count, current_usages_count AS current_usage_count,
  discount, created_date AS start_date, discount_code_end_date AS end_date, challenge_amount, challenge_step, email,
  {_OWNER} AS created_by, created_date AS created_at, coalesce(last_modified_date, created_date) AS updated_at,
  'admin' AS type, discount AS commission_percentage, CAST(NULL AS VARCHAR) AS deleted_at,
  CASE WHEN upper(status) = 'ACTIVE' THEN 'active' ELSE 'inactive' END AS status
FROM codes""",
    )
)
def export_discount_codes(spark, sf_dir):
    return sales.export_discount_codes(derived(spark, sf_dir, "discount_codes"), _keys(spark, sf_dir), OWNER)


@query(with_inputs(["platform_groups"], f"WITH {_GROUPS} SELECT * FROM groups"))
def export_platform_groups(spark, sf_dir):
    return _groups(spark, sf_dir)


_SETTINGS_COLUMNS = [
    "uuid", "100_profit_split", "2_percent_lower_target", "2_percent_more_daily_drawdown", "allow_expert_advisors",
    "breach_type", "delete_account_after_failure", "delete_account_after_failure_unit", "requires_stop_loss",
    "min_trading_days", "account_leverage", "profit_target", "profit_split", "max_open_lots",
]


@query(
    with_inputs(
        ["users", "default_settings"],
        f"""WITH {_USER_KEYS} SELECT {", ".join(f'"{c}"' for c in _SETTINGS_COLUMNS)},
{_OWNER} AS created_by, {_OWNER} AS updated_by, remark FROM in_default_settings""",
    )
)
def export_default_settings(spark, sf_dir):
    return people.export_default_settings(derived(spark, sf_dir, "default_settings"), _keys(spark, sf_dir), OWNER)


_PURCHASES_SQL = f"""WITH {_USER_KEYS}, {_CODES}
SELECT {uuid_sql('purchases', 'p.id')} AS uuid, u.uuid AS user_uuid, amount_total, currency,
  upper(payment_method) AS payment_method, payment_status, is_paid_aff_commission, user_data, original_amount,
  c.uuid AS discount_uuid, already_paid, payment_transaction_id, payment_response, payment_attempt_count, created_at,
  created_at AS updated_at, CAST(NULL AS VARCHAR) AS webhook_response, 'challenge' AS purchase_type,
  CAST(NULL AS VARCHAR) AS competition_uuid, CAST(NULL AS VARCHAR) AS ip
FROM in_purchases p LEFT JOIN user_keys u ON p.user_id = u.id
LEFT JOIN in_discount_codes o ON p.discount_id = o.id
LEFT JOIN codes c ON o.id IS NOT NULL AND o.code IS NOT DISTINCT FROM c.code"""


def _purchases(spark, sf_dir, **options):
    codes = derived(spark, sf_dir, "discount_codes")
    return sales.export_purchases(
        derived(spark, sf_dir, "purchases"), _keys(spark, sf_dir), codes, sales.surviving_codes(codes), **options
    )


@query(with_inputs(["users", "discount_codes", "purchases"], _PURCHASES_SQL))
def export_purchases(spark, sf_dir):
    return _purchases(spark, sf_dir)


@query(with_inputs(["users", "discount_codes", "purchases"], _PURCHASES_SQL))
def export_purchases_salted(spark, sf_dir):
    return _purchases(spark, sf_dir, spread_by=F.col("id"), hot_rows=500)


@query(_over_accounts([], "SELECT * FROM exported"))
def export_platform_accounts(spark, sf_dir):
    return _accounts(spark, sf_dir, keep_secrets=True)


@query(
    with_inputs(
        ["accounts"],
        """WITH own AS (SELECT * FROM in_accounts WHERE NOT starts_with(login, 'D#')),
  by_purchase AS (SELECT * FROM own QUALIFY row_number() OVER (PARTITION BY purchase_id ORDER BY src_id) = 1)
SELECT src_id, login, purchase_id, nullif("group", '') IS NOT NULL AS has_group FROM by_purchase
QUALIFY row_number() OVER (PARTITION BY login ORDER BY src_id) = 1""",
    )
)
def surviving_accounts(spark, sf_dir):
    df = acc.surviving_accounts(derived(spark, sf_dir, "accounts"), order_by=("src_id",))
    has_group = F.coalesce(F.col("group") != "", F.lit(False))
    return df.select("src_id", "login", "purchase_id", has_group.alias("has_group"))


# -- what refers to accounts ---------------------------------------------------------


@query(
    _over_accounts(
        [],
        f"""SELECT {uuid_sql('account_stats', 'src_id')} AS uuid, s.status, current_equity, yesterday_equity,
  performance_percent, current_overall_drawdown, current_daily_drawdown, average_win, average_loss, hit_ratio, best_trade,
  worst_trade, max_consecutive_wins, max_consecutive_losses, trades_without_stoploss, most_traded_asset, win_coefficient,
  avg_win_loss_coefficient, best_worst_coefficient, maximum_daily_drawdown, maximum_overall_drawdown, consistency_score,
  CAST(0 AS DOUBLE) AS lowest_watermark, current_equity AS highest_watermark, current_equity AS current_balance,
  current_equity - yesterday_equity AS current_profit, e.platform_group_uuid, e.uuid AS platform_account_uuid,
  0 AS trading_days_count, CAST(NULL AS DATE) AS first_trade_date, 0 AS total_trade_count
FROM in_account_stats s JOIN exported e ON s.account_login = e.platform_login_id""",
    )
)
def export_account_stats(spark, sf_dir):
    return acc.export_account_stats(
        derived(spark, sf_dir, "account_stats"), _exported(spark, sf_dir), id_keys=STATS_KEYS
    )


@query(
    _over_accounts(
        ["platform_events"],
        f"""SELECT {uuid_sql('platform_events', 'v.id')} AS uuid, e.user_uuid,
  CASE WHEN event = 'hardBreach' THEN 'hardBreached' ELSE event END AS event,
  CAST(v.created_at AS TIMESTAMP) AS created_at, CAST(v.created_at AS TIMESTAMP) AS updated_at,
  CASE WHEN event = 'hardBreach' THEN 'hardBreached' ELSE event END AS reason, e.uuid AS platform_account_uuid
FROM in_platform_events v JOIN exported e ON v.login = e.platform_login_id""",
    )
)
def export_platform_events(spark, sf_dir):
    return facts.export_platform_events(derived(spark, sf_dir, "platform_events"), _exported(spark, sf_dir))


@query(
    _over_accounts(
        ["breach_activities"],
        f"""SELECT {uuid_sql('breach_activities', '"Id"')} AS id, "BreachCount" AS breach_count,
  CAST("LastBreachDate" AS TIMESTAMP) AS last_breach_date, "IsBreached" <> 0 AS is_breached,
  e.uuid AS platform_account_uuid
FROM in_breach_activities b JOIN exported e ON b.account_login = e.platform_login_id""",
    )
)
def export_breach_activities(spark, sf_dir):
    return facts.export_breach_activities(derived(spark, sf_dir, "breach_activities"), _exported(spark, sf_dir))


@query(
    _over_accounts(
        ["payout_requests"],
        f"""SELECT {uuid_sql('payout_requests', 'p.id')} AS uuid, u.uuid AS user_uuid, type, amount, method,
  CASE WHEN p.status = 3 THEN 4 ELSE p.status END AS status, data, p.created_at, p.updated_at,
  e.uuid AS platform_account_uuid,
  CASE WHEN type = 'affiliate' THEN 'AFF-' || {code_sql('payouts', 'p.id')} END AS payout_id,
  compliance_note AS note, {_OWNER} AS note_created_by
FROM in_payout_requests p JOIN user_keys u ON p.user_id = u.id
LEFT JOIN exported e ON p.program_login = e.platform_login_id""",
    )
)
def export_payout_requests(spark, sf_dir):
    return sales.export_payout_requests(
        derived(spark, sf_dir, "payout_requests"), _keys(spark, sf_dir), _exported(spark, sf_dir), OWNER
    )


@query(
    _over_accounts(
        ["equity_daily"],
        f"""SELECT {uuid_sql('equity_daily', *EQUITY_KEYS)} AS id, CAST(day AS DATE) AS day,
  CAST(created_date AS TIMESTAMP) AS created_date, equity, balance, CAST(equity_eod_mt5 AS DOUBLE) AS equity_eod_mt5,
  e.uuid AS platform_account_uuid
FROM in_equity_daily q JOIN exported e ON q.trading_account = e.platform_login_id""",
    )
)
def export_equity_daily(spark, sf_dir):
    return facts.export_equity_daily(
        derived(spark, sf_dir, "equity_daily"), _exported(spark, sf_dir), id_keys=EQUITY_KEYS
    )


_DEAL_COLUMNS = f"""{uuid_sql('deals', *DEAL_KEYS)} AS id, deal_id, position_id, deal_type, profit,
  CAST(deal_time AS TIMESTAMP) AS deal_time, deal_entry, deal_price, deal_symbol, deal_stoploss,
  CAST(deal_volume AS DOUBLE) AS deal_volume, deal_commission, dupe_detected <> 0 AS dupe_detected,
  CAST(deal_swap AS DOUBLE) AS deal_swap, e.uuid AS platform_account_uuid"""


@query(
    _over_accounts(
        ["deals"],
        f"SELECT {_DEAL_COLUMNS} FROM in_deals q JOIN exported e ON q.trading_account = e.platform_login_id",
    )
)
def export_deals(spark, sf_dir):
    return facts.export_deals(derived(spark, sf_dir, "deals"), _exported(spark, sf_dir), id_keys=DEAL_KEYS)


@query(
    _over_accounts(
        ["deals"],
        f"SELECT {_DEAL_COLUMNS} FROM in_deals q JOIN exported e ON q.trading_account = e.platform_login_id",
    )
)
def export_deals_salted(spark, sf_dir):
    return facts.export_deals(
        derived(spark, sf_dir, "deals"),
        _exported(spark, sf_dir),
        id_keys=DEAL_KEYS,
        spread_by=F.struct("deal_id", "position_id"),
        hot_rows=1000,
    )


@query(
    _over_accounts(
        ["deals"],
        f"""SELECT {_DEAL_COLUMNS.replace("CAST(deal_time", "TRY_CAST(deal_time")}
FROM (SELECT * REPLACE (CASE WHEN position_id % 50 = 0 THEN 'n/a' ELSE deal_time END AS deal_time) FROM in_deals) q
JOIN exported e ON q.trading_account = e.platform_login_id
WHERE TRY_CAST(deal_time AS TIMESTAMP) >= TIMESTAMP '2001-12-31 00:00:00' - INTERVAL 180 DAY""",
    )
)
def export_recent_deals(spark, sf_dir):
    deals = derived(spark, sf_dir, "deals")
    spoiled = F.when(F.col("position_id") % 50 == 0, F.lit("n/a")).otherwise(F.col("deal_time"))
    return facts.export_recent_deals(
        deals.withColumn("deal_time", spoiled), _exported(spark, sf_dir), AS_OF, id_keys=DEAL_KEYS
    )


@query(
    _over_accounts(
        ["deals"],
        f"""SELECT {_DEAL_COLUMNS} FROM in_deals q JOIN exported e ON q.trading_account = e.platform_login_id
WHERE e.uuid = (SELECT min(uuid) FROM in_deals JOIN exported ON trading_account = platform_login_id)""",
    )
)
def export_slice_by_account(spark, sf_dir):
    deals, accounts = derived(spark, sf_dir, "deals"), _exported(spark, sf_dir)
    return facts.export_deals_of(deals, accounts, facts.first_account(deals, accounts), id_keys=DEAL_KEYS)


def _setting_sql(column: str) -> str:
    """A settings column as the check sees it: from the template, else its default."""
    present = set(_SETTINGS_COLUMNS) - {"uuid"}
    if column == "profit_target":
        return 'CAST(t.profit_target AS VARCHAR) AS profit_target'
    if column in present:
        return f't."{column}"'
    if column in acc.SETTING_FLAGS:
        return f'{str(acc.SETTING_FLAGS[column]).lower()} AS "{column}"'
    if column in acc.SETTING_NUMBERS:
        return f'{acc.SETTING_NUMBERS[column]} AS "{column}"'
    return f'CAST(NULL AS VARCHAR) AS "{column}"'


_COPIED = [
    c
    for c in acc.TARGETS["challenge_settings"]
    if c not in ("uuid", "platform_group_uuid", "platform_account_uuid", "created_at", "updated_at")
]
_SETTINGS = f"""
  t AS (SELECT * FROM in_default_settings ORDER BY uuid LIMIT 1),
  owners AS (SELECT uuid AS platform_group_uuid, CAST(NULL AS VARCHAR) AS platform_account_uuid FROM groups
             UNION ALL SELECT NULL, uuid FROM exported),
  settings AS (SELECT {uuid_sql('challenge_settings', 'platform_group_uuid', 'platform_account_uuid')} AS uuid,
    platform_group_uuid, platform_account_uuid, TIMESTAMP '2024-06-01 12:00:00' AS created_at,
    TIMESTAMP '2024-06-01 12:00:00' AS updated_at, {", ".join(_setting_sql(c) for c in _COPIED)}
    FROM owners, t)"""


def _settings(spark, sf_dir, accounts=None):
    accounts = accounts if accounts is not None else _exported(spark, sf_dir)
    return acc.export_challenge_settings(
        derived(spark, sf_dir, "default_settings"), _groups(spark, sf_dir), accounts, "2024-06-01 12:00:00"
    )


@query(_over_accounts(["default_settings"], f", {_SETTINGS} SELECT * FROM settings"))
def export_challenge_settings(spark, sf_dir):
    return _settings(spark, sf_dir)


@query(
    with_inputs(
        ["role_permissions"],
        f"SELECT id, role_uuid, permission FROM in_role_permissions WHERE role_uuid IN {rulebook.KEPT_ROLE_IDS}",
    )
)
def export_role_permissions(spark, sf_dir):
    return people.export_role_permissions(derived(spark, sf_dir, "role_permissions"))


# -- audits ----------------------------------------------------------------------------


def _flat(steps: DataFrame) -> DataFrame:
    """Steps with their details as JSON text."""
    return steps.withColumn("details", F.to_json("details"))


def _detail(**values: str) -> str:
    pairs = " || ',' || ".join(f"'\"{k}\":\"' || CAST({v} AS VARCHAR) || '\"'" for k, v in values.items())
    return f"'{{' || {pairs} || '}}'"


def _step_sql(no: int, name: str, before: str, after: str, reason: str, source: str, details: str) -> str:
    return (
        f"SELECT {no} AS step_no, '{name}' AS step_name, {before} AS records_before, {after} AS records_after,"
        f" {before} - {after} AS records_removed, '{reason}' AS reason, {details} AS details FROM {source}"
    )


_ACCOUNT_COUNTS = """, n AS (SELECT (SELECT count(*) FROM in_accounts) AS n_all, (SELECT count(*) FROM own) AS n_own,
  (SELECT count(*) FROM in_accounts WHERE starts_with(login, 'D#')) AS n_foreign,
  (SELECT count(*) FROM by_purchase) AS n_pur, (SELECT count(*) FROM by_login) AS n_log,
  (SELECT count(*) FROM grouped WHERE "group" IS NOT NULL) AS n_grp, (SELECT count(*) FROM exported) AS n_fin,
  (SELECT count(*) FROM (SELECT DISTINCT platform_name, account_stage, account_type, initial_balance FROM groups)) AS n_com)
"""


@query(
    _over_accounts(
        [],
        _ACCOUNT_COUNTS
        + " UNION ALL ".join(
            [
                _step_sql(1, "Foreign platform filtering", "n_all", "n_own", "not accounts of this platform", "n",
                          _detail(removed="n_foreign", pattern="'D#*'")),
                _step_sql(2, "Purchase deduplication", "n_own", "n_pur", "purchase must be unique", "n",
                          _detail(duplicates="n_own - n_pur", unique="n_pur")),
                _step_sql(3, "Login deduplication", "n_pur", "n_log", "login must be unique", "n",
                          _detail(duplicates="n_pur - n_log", unique="n_log")),
                _step_sql(4, "Group filtering", "n_log", "n_grp", "accounts need a group", "n",
                          _detail(with_group="n_grp", without_group="n_log - n_grp")),
                _step_sql(5, "Group combination filtering", "n_grp", "n_fin", "only known combinations are kept", "n",
                          _detail(valid_combinations="n_com", removed="n_grp - n_fin")),
            ]
        ),
    )
)
def audit_accounts(spark, sf_dir):
    return _flat(
        audits.audit_accounts(
            derived(spark, sf_dir, "accounts"),
            derived(spark, sf_dir, "account_stats"),
            _groups(spark, sf_dir),
            _exported(spark, sf_dir),
            derived(spark, sf_dir, "preferred_logins"),
            order_by=("src_id",),
        )
    )


@query(
    with_inputs(
        ["discount_codes"],
        f"""WITH {_CODES}, n AS (SELECT (SELECT count(*) FROM in_discount_codes) AS a, (SELECT count(*) FROM codes) AS b)
{_step_sql(1, "Code deduplication", "a", "b", "code must be unique", "n", _detail(duplicates="a - b", unique="b"))}""",
    )
)
def audit_discount_codes(spark, sf_dir):
    codes = derived(spark, sf_dir, "discount_codes")
    return _flat(audits.audit_discount_codes(codes, sales.surviving_codes(codes)))


@query(
    with_inputs(
        ["users", "discount_codes", "purchases"],
        f"""WITH n AS (SELECT count(*) AS a,
  count(*) FILTER (user_id IN (SELECT id FROM in_users)) AS u,
  count(*) FILTER (discount_id IN (SELECT id FROM in_discount_codes)) AS d FROM in_purchases)
{_step_sql(1, "User mapping", "a", "a", "purchases keep an unknown buyer as null", "n",
           _detail(with_user="u", without_user="a - u"))}
UNION ALL {_step_sql(2, "Discount mapping", "a", "a", "discounts are optional", "n",
                     _detail(with_discount="d", without_discount="a - d"))}""",
    )
)
def audit_purchases(spark, sf_dir):
    purchases = derived(spark, sf_dir, "purchases")
    final = sales.export_purchases(purchases, _keys(spark, sf_dir))
    return _flat(
        audits.audit_purchases(
            purchases, derived(spark, sf_dir, "users"), derived(spark, sf_dir, "discount_codes"), final
        )
    )


_FACTS_AUDIT = ", n AS (SELECT count(*) AS a, count(*) FILTER (trading_account IN (SELECT platform_login_id FROM exported)) AS k FROM {}) "


@query(
    _over_accounts(
        ["equity_daily"],
        _FACTS_AUDIT.format("in_equity_daily")
        + _step_sql(1, "Account mapping", "a", "k", "account must exist", "n",
                    _detail(with_account="k", without_account="a - k")),
    )
)
def audit_equity_daily(spark, sf_dir):
    return _flat(audits.audit_facts(derived(spark, sf_dir, "equity_daily"), _exported(spark, sf_dir)))


@query(
    _over_accounts(
        ["deals"],
        _FACTS_AUDIT.format("in_deals")
        + _step_sql(1, "Account mapping", "a", "k", "account must exist", "n",
                    _detail(with_account="k", without_account="a - k")),
    )
)
def audit_deals(spark, sf_dir):
    return _flat(audits.audit_facts(derived(spark, sf_dir, "deals"), _exported(spark, sf_dir)))


@query(
    _over_accounts(
        [],
        ", n AS (SELECT (SELECT count(*) FROM groups) AS g, (SELECT count(*) FROM exported) AS e) "
        + _step_sql(1, "Groups", "CAST(0 AS BIGINT)", "g", "each group needs settings", "n", _detail(processed="g"))
        + " UNION ALL "
        + _step_sql(2, "Accounts", "g", "g + e", "each account needs settings", "n", _detail(processed="e")).replace(
            "g - g + e", "g - (g + e)"
        ),
    )
)
def audit_settings(spark, sf_dir):
    return _flat(audits.audit_settings(_groups(spark, sf_dir), _exported(spark, sf_dir)))


@query(
    _over_accounts(
        ["default_settings"],
        f""", {_SETTINGS} SELECT count(*) AS total, count(platform_group_uuid) AS for_groups,
  count(platform_account_uuid) AS for_accounts,
  count(*) FILTER ("100_profit_split") AS "100_profit_split_true",
  count(*) FILTER (NOT "100_profit_split") AS "100_profit_split_false",
  count(*) FILTER (visible_on_leaderboard) AS visible_on_leaderboard_true,
  count(*) FILTER (NOT visible_on_leaderboard) AS visible_on_leaderboard_false FROM settings""",
    )
)
def settings_summary(spark, sf_dir):
    return audits.settings_summary(_settings(spark, sf_dir), ["100_profit_split", "visible_on_leaderboard"])


@query(
    _over_accounts(
        [],
        """, p AS (SELECT 'current_phase' AS measure, CAST(current_phase AS VARCHAR) AS value FROM exported
  UNION ALL SELECT 'status', CAST(status AS VARCHAR) FROM exported
  UNION ALL SELECT 'funded_status', CAST(funded_status AS VARCHAR) FROM exported)
SELECT measure, value, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM exported), 2) AS percentage
FROM p GROUP BY measure, value""",
    )
)
def account_distributions(spark, sf_dir):
    return audits.account_distributions(_exported(spark, sf_dir))


@query(
    _over_accounts(
        [],
        """SELECT count(*) AS final_records, (SELECT count(*) FROM in_accounts) AS original_records,
  (SELECT count(*) FROM in_accounts) - count(*) AS total_removed,
  round(100.0 * count(*) / (SELECT count(*) FROM in_accounts), 2) AS retention_rate, 30 AS total_columns FROM exported""",
    )
)
def account_summary(spark, sf_dir):
    return audits.summary(derived(spark, sf_dir, "accounts"), _exported(spark, sf_dir))


# -- everything ------------------------------------------------------------------------

_ROWS = {
    "users": "in_users",
    "default_settings": "in_default_settings",
    "discount_codes": "codes",
    "platform_groups": "groups",
    "purchases": "in_purchases",
    "platform_accounts": "exported",
    "account_stats": "(SELECT 1 FROM in_account_stats JOIN exported ON account_login = platform_login_id)",
    "platform_events": "(SELECT 1 FROM in_platform_events JOIN exported ON login = platform_login_id)",
    "breach_activities": "(SELECT 1 FROM in_breach_activities JOIN exported ON account_login = platform_login_id)",
    "payout_requests": "(SELECT 1 FROM in_payout_requests p JOIN user_keys u ON p.user_id = u.id)",
    "equity_daily": "(SELECT 1 FROM in_equity_daily JOIN exported ON trading_account = platform_login_id)",
    "deals": "(SELECT 1 FROM in_deals JOIN exported ON trading_account = platform_login_id)",
    "recent_deals": """(SELECT 1 FROM in_deals JOIN exported ON trading_account = platform_login_id
      WHERE CAST(deal_time AS TIMESTAMP) >= TIMESTAMP '2001-12-31 00:00:00' - INTERVAL 180 DAY)""",
    "challenge_settings": "(SELECT 1 FROM groups UNION ALL SELECT 1 FROM exported)",
}


@query(
    _over_accounts(
        ["discount_codes", "default_settings", "platform_events", "breach_activities", "payout_requests",
         "equity_daily", "deals"],
        f", {_CODES} "
        + " UNION ALL ".join(
            f"SELECT '{n}' AS \"table\", true AS ok, count(*) AS rows FROM {t}" for n, t in _ROWS.items()
        ),
    )
)
def export_all(spark, sf_dir):
    folder = stage_path(spark, "all_exports")
    sources = {n: derived(spark, sf_dir, n) for n in INPUTS}
    _, outcomes = everything.run_all(
        sources,
        NAMES,
        OWNER,
        PREFIXES,
        write=lambda df, name: df.write.parquet(f"{folder}/{name}"),
        as_of=AS_OF,
        account_order=("src_id",),
        stats_last_by=("src_id",),
        deal_keys=DEAL_KEYS,
        equity_keys=EQUITY_KEYS,
        stats_keys=STATS_KEYS,
    )
    done = None
    for o in outcomes:
        rows = spark.read.parquet(f"{folder}/{o.name}") if o.ok else spark.range(0)
        line = rows.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(o.name).alias("table"), F.lit(o.ok).alias("ok"), "rows"
        )
        done = line if done is None else done.unionByName(line)
    return done


@query(
    with_inputs(
        ["payout_requests"],
        """SELECT 'type' AS measure, type AS value, count(*) AS count FROM in_payout_requests GROUP BY ALL
UNION ALL SELECT 'status', CAST(CASE WHEN status = 3 THEN 4 ELSE status END AS VARCHAR), count(*) FROM in_payout_requests GROUP BY ALL
UNION ALL SELECT 'method', method, count(*) FROM in_payout_requests GROUP BY ALL""",
    )
)
def payout_frequencies(spark, sf_dir):
    payouts = derived(spark, sf_dir, "payout_requests")
    status = F.when(F.col("status") == 3, 4).otherwise(F.col("status"))
    return audit.distribution(payouts.withColumn("status", status), ["type", "status", "method"]).drop("percentage")
