"""Discount codes, purchases and payouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transhume import rulebook
from transhume.functions.keys import code_from, uuid_from
from transhume.operators import conform, dedup, lookup, rules
from transhume.plans.people import owner_uuid
from transhume.schemas import TARGETS


def surviving_codes(codes: DataFrame, order_by: Sequence[str] = ("id",)) -> DataFrame:
    """First row per code, with its new uuid."""
    return dedup.keep_first(codes, ["code"], order_by).withColumn("uuid", uuid_from("discount_codes", "id"))


def export_discount_codes(
    codes: DataFrame,
    keys: DataFrame | None,
    owner_email: str,
    order_by: Sequence[str] = ("id",),
    columns: Sequence[str] | None = TARGETS["discount_codes"],
) -> DataFrame:
    """One row per code. Without user keys the creator stays null."""
    nothing = F.lit(None).cast("string")
    df = surviving_codes(codes, order_by)
    df = conform.with_constants(
        df, {"status": rules.two_way(F.upper("status") == "ACTIVE", "active", "inactive")}
    )
    df = conform.copy_columns(
        df,
        {
            "name": "code",
            "max_usage_count": "max_usages_count",
            "current_usage_count": "current_usages_count",
            "end_date": "discount_code_end_date",
            "created_at": "created_date",
            "start_date": "created_date",
            "commission_percentage": "discount",
        },
    )
    changes = [F.col(c) for c in ("last_modified_date", "created_date") if c in df.columns]
    if changes:
        df = df.withColumn("updated_at", rules.first_present(*changes))
    creator = nothing if keys is None else owner_uuid(keys, owner_email)
    df = conform.with_defaults(df, {"deleted_at": nothing})
    df = conform.with_constants(df, {"type": F.lit("admin"), "created_by": creator})
    return conform.select_available(df, columns)


def purchase_keys(purchases: DataFrame) -> DataFrame:
    return purchases.select("id", uuid_from("purchases", "id").alias("uuid"))


def export_purchases(
    purchases: DataFrame,
    keys: DataFrame,
    codes: DataFrame | None = None,
    exported_codes: DataFrame | None = None,
    spread_by: Column | None = None,
    hot_rows: int = lookup.HOT_ROWS,
    columns: Sequence[str] | None = TARGETS["purchases"],
) -> DataFrame:
    """Purchases with the uuids of buyer and discount.

    The discount goes by way of its code, so the id of a removed duplicate leads to the
    code that stayed. ``spread_by`` salts buyers and discounts with many purchases.
    """
    salting = {"salt_hot": spread_by, "hot_rows": hot_rows, "hot_in": purchases}
    nothing = F.lit(None).cast("string")
    df = lookup.lookup(purchases, keys, "user_id", "id", {"user_uuid": "uuid"}, unique=True, **salting)
    if codes is None or exported_codes is None:
        df = df.withColumn("discount_uuid", nothing)
    else:
        df = lookup.lookup_two_hop(
            df, codes, exported_codes, "discount_id", "id", "code", "code", {"discount_uuid": "uuid"}, **salting
        )
    df = conform.with_constants(df, {"uuid": uuid_from("purchases", "id")})
    df = conform.with_defaults(
        df,
        {
            "updated_at": F.col("created_at"),
            "webhook_response": nothing,
            "purchase_type": F.lit("challenge"),
            "competition_uuid": nothing,
            "ip": nothing,
        },
    )
    if "payment_method" in df.columns:
        df = df.withColumn("payment_method", F.upper("payment_method"))
    return conform.select_available(df, columns)


def export_payout_requests(
    payouts: DataFrame,
    keys: DataFrame,
    accounts: DataFrame,
    owner_email: str,
    spread_by: Column | None = None,
    hot_rows: int = lookup.HOT_ROWS,
    columns: Sequence[str] | None = TARGETS["payout_requests"],
) -> DataFrame:
    """Payouts of known users; the account may be unknown.

    ``spread_by`` salts users and accounts with many payouts.
    """
    options = {"text": True, "unique": True, "salt_hot": spread_by, "hot_rows": hot_rows, "hot_in": payouts}
    df = lookup.lookup(payouts, keys, "user_id", "id", {"user_uuid": "uuid"}, inner=True, **options)
    account = {"platform_account_uuid": "uuid"}
    df = lookup.lookup(df, accounts, "program_login", "platform_login_id", account, **options)
    code = F.concat(F.lit("AFF-"), code_from("payouts", "id"))
    df = conform.with_constants(
        df,
        {
            "uuid": uuid_from("payout_requests", "id"),
            "payout_id": F.when(F.col("type") == "affiliate", code),
            "note": F.col("compliance_note"),
            "note_created_by": owner_uuid(keys, owner_email),
            "status": rules.remap(F.col("status"), rulebook.PAYOUT_STATUS_CHANGES),
        },
    )
    df = conform.drop_required(df, ["id", "user_id", "program_login", "compliance_note", "approved_by"])
    return conform.select_available(df, columns)
