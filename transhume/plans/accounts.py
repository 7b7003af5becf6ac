"""Trading accounts, their groups, statistics and settings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transhume import rulebook
from transhume.functions.keys import random_uuid, uuid_from
from transhume.functions.text import blank_to_null, present
from transhume.operators import conform, dedup, filters, lookup, rules
from transhume.operators.audit import Watch, unwatched
from transhume.rulebook import AccountRules
from transhume.schemas import TARGETS

GROUP_KEYS = ["platform_name", "account_stage", "account_type", "initial_balance"]
_PREFERRED = "_preferred"


def export_platform_groups(
    groups: DataFrame, prefixes: Sequence[str], kind: str = "challenge", columns: Sequence[str] | None = None
) -> DataFrame:
    """Groups of one kind whose names start with a prefix, platform names in upper case."""
    df = filters.equals_and_prefix(groups, "group_type", kind, "name", prefixes)
    if "platform_name" in df.columns:
        df = df.withColumn("platform_name", F.upper("platform_name"))
    return conform.select_available(df, columns)


def surviving_accounts(
    accounts: DataFrame,
    preferences: DataFrame | None = None,
    order_by: Sequence[str] = ("created_at", "login"),
    null_purchases: str = dedup.COLLAPSE,
    foreign_prefix: str = rulebook.FOREIGN_LOGIN_PREFIX,
    preferred_last_by: Sequence[str] | None = None,
    watch: Watch = unwatched,
) -> DataFrame:
    """Own accounts, one per purchase and then one per login.

    Where a preference names the login of a purchase, that row wins, and preferred
    rows come before others when logins are made unique. Of several preferences of a purchase the last
    in ``preferred_last_by`` order counts. ``watch`` sees the rows after each step.
    """
    df = watch(filters.exclude_prefix(watch(accounts, "read"), "login", foreign_prefix), "own")
    if preferences is None:
        df = watch(dedup.keep_first(df, ["purchase_id"], order_by, null_purchases), "one_per_purchase")
        return watch(dedup.keep_first(df, ["login"], order_by), "one_per_login")
    df = dedup.flag_preferred(df, preferences, "purchase_id", "login", _PREFERRED, preferred_last_by)
    df = watch(dedup.keep_preferred(df, ["purchase_id"], order_by, F.col(_PREFERRED), null_purchases), "one_per_purchase")
    return watch(dedup.keep_preferred(df, ["login"], order_by, F.col(_PREFERRED)), "one_per_login").drop(_PREFERRED)


def with_known_group(
    accounts: DataFrame, stats: DataFrame | None, last_by: Sequence[str] = ("group",), keep_unknown: bool = False
) -> DataFrame:
    """Account group, else the one in the statistics; accounts with neither go."""
    df = accounts
    if stats is not None:
        known = stats.filter(present(F.col("group")))
        df = lookup.lookup(
            df, known, "login", "account_login", {"group_from_stats": "group"}, text=True, last_by=last_by
        )
        df = df.withColumn("group", F.coalesce(blank_to_null(F.col("group")), F.col("group_from_stats")))
        df = df.drop("group_from_stats")
    return df if keep_unknown else filters.any_present(df, "group")


def with_account_rules(accounts: DataFrame, names: AccountRules, groups: DataFrame | None) -> DataFrame:
    """Phase, status, funded status and the group on the new platform."""
    if groups is None:
        df = accounts.withColumn("_funded", F.col("group").isin(list(names.funded)))
    else:
        df = lookup.flag_member(accounts, "group", groups, "funded_group_name", names.funded, "_funded")
    df = conform.with_defaults(df, {"is_active": F.lit(None).cast("int"), "action_type": F.lit(None).cast("string")})
    funded_at, funded, active = F.col("funded_at"), F.col("_funded"), F.col("is_active")
    state = rules.funded_state(rules.phase_of(F.col("group"), rulebook.PHASE_MARKS), funded_at, funded, active)
    target = rules.target_group(
        F.col("action_type"),
        funded_at,
        funded,
        active,
        names.competition_target,
        names.funded_target,
        names.evaluation_target,
    )
    return df.withColumns({**state, "remote_group_name": target}).drop("_funded")


def with_group_uuid(accounts: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Uuid of the group with the account's platform, stage, type and balance.

    Accounts without such a group go. The groups' combinations must be unique, because
    a repeated one would repeat accounts; the join raises where one is not.
    """
    if groups is None:
        return accounts.withColumn("platform_group_uuid", F.lit(None).cast("string"))
    combos = groups.withColumn("initial_balance", F.col("initial_balance").cast("long"))
    df = accounts.withColumn("initial_balance", F.col("initial_balance").cast("long"))
    return lookup.composite_join(df, combos, GROUP_KEYS, {"platform_group_uuid": "uuid"}, unique=True)


def export_platform_accounts(
    accounts: DataFrame,
    names: AccountRules,
    user_keys: DataFrame | None = None,
    purchase_keys: DataFrame | None = None,
    stats: DataFrame | None = None,
    preferences: DataFrame | None = None,
    account_data: DataFrame | None = None,
    groups: DataFrame | None = None,
    order_by: Sequence[str] = ("created_at", "login"),
    stats_last_by: Sequence[str] = ("group",),
    data_last_by: Sequence[str] = ("main_password", "investor_password"),
    null_purchases: str = dedup.COLLAPSE,
    keep_secrets: bool = False,
    spread_by: Column | None = None,
    hot_rows: int = lookup.HOT_ROWS,
    columns: Sequence[str] | None = TARGETS["platform_accounts"],
    preferred_last_by: Sequence[str] | None = None,
    watch: Watch = unwatched,
) -> DataFrame:
    """Accounts of the target platform. Sources that are absent leave their columns null.

    ``spread_by`` salts users with many accounts and, where they were kept, accounts
    without a purchase. ``watch`` sees the rows after each step that may drop some.
    """
    nothing = F.lit(None).cast("string")
    salting = {"salt_hot": spread_by, "hot_rows": hot_rows, "hot_in": accounts}
    df = surviving_accounts(accounts, preferences, order_by, null_purchases, preferred_last_by=preferred_last_by, watch=watch)
    # The lookups by login follow each other: after the last dedup the rows already lie by login.
    df = watch(with_known_group(df, stats, stats_last_by), "with_group")
    if account_data is not None and keep_secrets:
        passwords = {"main_password": "main_password", "investor_password": "investor_password"}
        df = lookup.lookup(
            df, account_data, "login", "account_login", passwords, text=True, last_by=data_last_by
        )
    else:
        df = df.withColumns({"main_password": nothing, "investor_password": nothing})
    df = with_account_rules(df, names, groups)
    df = df.withColumn("uuid", uuid_from("platform_accounts", "login"))
    if user_keys is None:
        df = df.withColumns({"user_uuid": nothing, "identity_status": nothing})
    else:
        taken = {"user_uuid": "uuid", "identity_status": "identity_status"}
        df = lookup.lookup(df, user_keys, "user_id", "id", taken, unique=True, **salting)
    df = df.withColumn("is_kyc", rules.flag_if(F.col("identity_status"), "completed"))
    if purchase_keys is None:
        df = df.withColumn("purchase_uuid", nothing)
    else:
        # The key is made after the lookup: as text that does not compress it is most of what would be shuffled.
        df = lookup.lookup(df, purchase_keys, "purchase_id", "id", {"_purchase": "id"}, unique=True, **salting)
        made = F.when(F.col("_purchase").isNotNull(), uuid_from("purchases", "_purchase"))
        df = df.withColumn("purchase_uuid", made).drop("_purchase")
    df = conform.with_defaults(
        df,
        {
            "updated_at": rules.first_present(F.col("funded_at"), F.col("created_at")),
            "deleted_at": nothing,
            "platform_login_id": F.col("login"),
            "platform_name": F.lit("MT5"),
            "profit_target": F.col("target") if "target" in df.columns else F.lit(None).cast("double"),
        },
    )
    df = conform.fill_cast(
        df, {"is_trades_check": "trades_check", "is_trade_agreement": "contract_sign_staus"}
    )
    if "account_type" in df.columns:
        df = df.withColumn(
            "account_type",
            rules.code_map(F.col("account_type"), rulebook.ACCOUNT_TYPES, rulebook.DEFAULT_ACCOUNT_TYPE),
        )
    if "account_stages" in df.columns:
        stage = rules.code_map(F.col("account_stages"), rulebook.ACCOUNT_STAGES, rulebook.DEFAULT_ACCOUNT_STAGE)
    else:
        stage = F.lit(rulebook.DEFAULT_ACCOUNT_STAGE)
    df = conform.with_defaults(df, {"account_stage": stage})
    df = watch(with_group_uuid(df, groups), "with_group_uuid")
    df = conform.with_defaults(df, {"platform_user_id": nothing})
    df = conform.with_constants(df, {"action_type": F.lit("challenge")})
    return conform.select_available(df, columns)


def export_account_stats(
    stats: DataFrame,
    accounts: DataFrame,
    id_keys: Sequence[str] | None = None,
    spread_by: Column | None = None,
    hot_rows: int = lookup.HOT_ROWS,
    columns: Sequence[str] | None = TARGETS["account_stats"],
) -> DataFrame:
    """Statistics of accounts that have both a uuid and a group.

    A login may come with several rows, so that the uuid is random unless ``id_keys``
    names a unique key. ``spread_by`` salts logins with many rows.
    """
    taken = {"platform_account_uuid": "uuid", "platform_group_uuid": "platform_group_uuid"}
    df = lookup.lookup(
        stats,
        accounts,
        "account_login",
        "platform_login_id",
        taken,
        text=True,
        unique=True,
        inner=True,
        required=list(taken),
        salt_hot=spread_by,
        hot_rows=hot_rows,
        sift=True,
    )
    df = conform.with_constants(
        df,
        {
            "uuid": uuid_from("account_stats", *id_keys) if id_keys else random_uuid(),
            "current_balance": F.col("current_equity"),
            "current_profit": rules.difference(F.col("current_equity"), F.col("yesterday_equity")),
            "lowest_watermark": F.lit(0.0),
            "highest_watermark": F.col("current_equity"),
            "trading_days_count": F.lit(0),
            "first_trade_date": F.lit(None).cast("date"),
            "total_trade_count": F.lit(0),
        },
    )
    df = conform.drop_required(df, ["account_login", "group"])
    return conform.select_available(df, columns)


# Setting columns and what they hold where the template lacks them.
SETTING_FLAGS = {
    "100_profit_split": False,
    "2_percent_lower_target": False,
    "2_percent_more_daily_drawdown": False,
    "2_percent_more_max_drawdown": False,
    "allow_expert_advisors": False,
    "close_all_positions_on_friday": False,
    "double_leverage": False,
    "held_over_the_weekend": False,
    "no_sl_required": False,
    "requires_stop_loss": True,
    "requires_take_profit": False,
    "visible_on_leaderboard": True,
}
SETTING_NUMBERS = {"account_leverage": 0, "profit_split": 0, "max_drawdown": 0, "max_daily_drawdown": 0}


def export_challenge_settings(
    template: DataFrame,
    groups: DataFrame,
    accounts: DataFrame,
    as_of: str | None = None,
    order_by: str = "uuid",
    columns: Sequence[str] = TARGETS["challenge_settings"],
) -> DataFrame:
    """The default settings once for every group and once for every account."""
    own = {"uuid", "platform_group_uuid", "platform_account_uuid", "created_at", "updated_at"}
    copied = [c for c in columns if c not in own]
    nothing = F.lit(None).cast("string")
    target = F.col("profit_target") if "profit_target" in template.columns else F.lit("")
    settings = conform.with_defaults(template, {c: F.lit(v) for c, v in SETTING_FLAGS.items()})
    settings = conform.with_defaults(settings, {c: F.lit(v) for c, v in SETTING_NUMBERS.items()})
    settings = settings.withColumn("profit_target", rules.number_text(target))
    settings = conform.with_defaults(settings, {c: nothing for c in copied})
    owners = groups.select(F.col("uuid").alias("platform_group_uuid"), nothing.alias("platform_account_uuid")).unionByName(
        accounts.select(nothing.alias("platform_group_uuid"), F.col("uuid").alias("platform_account_uuid"))
    )
    now = rules.run_time(as_of)
    df = lookup.with_template(owners, settings, copied, order_by)
    df = conform.with_constants(
        df,
        {
            "uuid": uuid_from("challenge_settings", "platform_group_uuid", "platform_account_uuid"),
            "created_at": now,
            "updated_at": now,
        },
    )
    return conform.select_required(df, columns)
