"""Event and time-stamped tables that refer to accounts.

Each is one scan, one lookup and a projection. The accounts table is the only other
input: it is broadcast when its measured size allows, otherwise both sides are
shuffled by login, the facts without most of those whose account is unknown. ``spread_by`` then salts the logins that hold many rows. Row
keys are made after the lookup, so that none is computed for a row that goes.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transhume import rulebook
from transhume.functions.keys import random_uuid, uuid_from
from transhume.functions.parse import SECONDS_SHAPE, try_timestamp
from transhume.functions.text import text_of
from transhume.operators import conform, filters, lookup, rules
from transhume.schemas import TARGETS


def with_account(
    df: DataFrame,
    accounts: DataFrame | None,
    login: str,
    drop_orphans: bool = True,
    with_user: bool = False,
    spread_by: Column | None = None,
    hot_rows: int = lookup.HOT_ROWS,
    sift: bool = True,
) -> DataFrame:
    """Account uuid (and its user's) by login, compared as text."""
    taken = {"platform_account_uuid": "uuid"}
    if with_user:
        taken["user_uuid"] = "user_uuid"
    if accounts is None:
        return df.withColumns({c: F.lit(None).cast("string") for c in taken})
    return lookup.lookup(
        df,
        accounts,
        login,
        "platform_login_id",
        taken,
        text=True,
        unique=True,
        inner=drop_orphans,
        required=["platform_account_uuid"],
        salt_hot=spread_by,
        hot_rows=hot_rows,
        sift=sift,
    )


def _row_id(entity: str, id_keys: Sequence[str] | None) -> Column:
    """Derived from a unique key where one is named, else random: nothing refers to these rows."""
    return uuid_from(entity, *id_keys) if id_keys else random_uuid()


def export_platform_events(
    events: DataFrame,
    accounts: DataFrame | None,
    spread_by: Column | None = None,
    hot_rows: int = lookup.HOT_ROWS,
    columns: Sequence[str] | None = TARGETS["platform_events"],
) -> DataFrame:
    df = with_account(events, accounts, "login", with_user=True, spread_by=spread_by, hot_rows=hot_rows)
    df = conform.with_constants(
        df,
        {
            "uuid": uuid_from("platform_events", "id"),
            "event": rules.remap(F.col("event"), rulebook.EVENT_CHANGES),
        },
    )
    df = conform.copy_columns(df, {"reason": "event", "updated_at": "created_at"})
    df = conform.parse_seconds(df, ["created_at", "updated_at"], SECONDS_SHAPE)
    df = conform.drop_if_present(df, ["id", "user_id", "login", "hourl_gap_status"])
    return conform.select_available(df, columns)


def export_breach_activities(
    breaches: DataFrame,
    accounts: DataFrame | None,
    spread_by: Column | None = None,
    hot_rows: int = lookup.HOT_ROWS,
    columns: Sequence[str] | None = TARGETS["breach_activities"],
) -> DataFrame:
    # Column names differ by more than case, so the source id is renamed out of the way first.
    df = conform.rename(
        breaches,
        {
            "Id": "_source_id",
            "BreachCount": "breach_count",
            "LastBreachDate": "last_breach_date",
            "IsBreached": "is_breached",
        },
    )
    df = with_account(df, accounts, "account_login", spread_by=spread_by, hot_rows=hot_rows)
    df = conform.with_constants(df, {"id": uuid_from("breach_activities", "_source_id")})
    df = conform.cast_columns(df, {"is_breached": "boolean"})
    df = conform.parse_seconds(df, ["last_breach_date"], SECONDS_SHAPE)
    df = conform.drop_if_present(df, ["_source_id", "account_login"])
    return conform.select_available(df, columns)


def export_equity_daily(
    equity: DataFrame,
    accounts: DataFrame | None,
    id_keys: Sequence[str] | None = None,
    spread_by: Column | None = None,
    hot_rows: int = lookup.HOT_ROWS,
    columns: Sequence[str] = TARGETS["equity_daily"],
) -> DataFrame:
    """Daily equity of known accounts; text that is no date or time is an error."""
    df = with_account(equity, accounts, "trading_account", spread_by=spread_by, hot_rows=hot_rows)
    df = filters.not_null(df, "platform_account_uuid")
    df = conform.with_constants(df, {"id": _row_id("equity_daily", id_keys)})
    types = {"day": "date", "created_date": "timestamp_ntz", "equity_eod_mt5": "double"}
    return conform.select_required(conform.cast_columns(df, types), columns)


def _deals(
    deals: DataFrame,
    accounts: DataFrame | None,
    id_keys: Sequence[str] | None,
    spread_by: Column | None,
    hot_rows: int,
    columns: Sequence[str] | None,
    types: dict[str, str],
    sift: bool = True,
) -> DataFrame:
    df = with_account(deals, accounts, "trading_account", spread_by=spread_by, hot_rows=hot_rows, sift=sift)
    df = filters.not_null(df, "platform_account_uuid")
    df = conform.with_constants(df, {"id": _row_id("deals", id_keys)})
    return conform.select_available(conform.cast_columns(df, types), columns)


_DEAL_TYPES = {"deal_volume": "double", "dupe_detected": "boolean", "deal_swap": "double"}


def export_deals(
    deals: DataFrame,
    accounts: DataFrame | None,
    id_keys: Sequence[str] | None = None,
    spread_by: Column | None = None,
    hot_rows: int = lookup.HOT_ROWS,
    columns: Sequence[str] | None = TARGETS["deals"],
) -> DataFrame:
    """Deals of known accounts; a deal time that does not parse is an error."""
    return _deals(deals, accounts, id_keys, spread_by, hot_rows, columns, {**_DEAL_TYPES, "deal_time": "timestamp_ntz"})


def export_recent_deals(
    deals: DataFrame,
    accounts: DataFrame | None,
    as_of: dt.datetime,
    days: int = 180,
    id_keys: Sequence[str] | None = None,
    spread_by: Column | None = None,
    hot_rows: int = lookup.HOT_ROWS,
    columns: Sequence[str] | None = TARGETS["deals"],
) -> DataFrame:
    """Deals of the last days; deal times that do not parse count as unknown and go."""
    timed = deals.withColumn("deal_time", try_timestamp(F.col("deal_time")))
    recent = filters.since_days(timed, "deal_time", as_of, days)
    return _deals(recent, accounts, id_keys, spread_by, hot_rows, columns, _DEAL_TYPES)


def export_deals_of(
    deals: DataFrame,
    accounts: DataFrame,
    account_uuid: str | Column,
    id_keys: Sequence[str] | None = None,
    columns: Sequence[str] | None = TARGETS["deals"],
) -> DataFrame:
    """Deals of one account. Its row is broadcast, so that no deal is shuffled, however many deals a login has."""
    one = F.broadcast(filters.slice_by_key(accounts, "uuid", account_uuid))
    types = {**_DEAL_TYPES, "deal_time": "timestamp_ntz"}
    return _deals(deals, one, id_keys, None, lookup.HOT_ROWS, columns, types, sift=False)


def first_account(deals: DataFrame, accounts: DataFrame) -> Column:
    """The least uuid of the accounts with deals, as a scalar subquery.

    Every login is one row a task before it is shuffled: rows of a frequent login alone compress to so little that
    the run-time split of skewed partitions, which goes by stored bytes, leaves them in one task.
    """
    logins = deals.select(text_of(F.col("trading_account")).alias("login")).distinct()
    return lookup.exists_in(accounts, logins, "platform_login_id", "login", text=True).agg(F.min("uuid")).scalar()


def slice_deals(deals: DataFrame, account_uuid: str | Column) -> DataFrame:
    """Exported deals of one account."""
    return filters.slice_by_key(deals, "platform_account_uuid", account_uuid)
