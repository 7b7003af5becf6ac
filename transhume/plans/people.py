"""Users, roles and what is owned by a person."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transhume import rulebook
from transhume.functions.keys import code_from, uuid_from
from transhume.operators import conform, filters, lookup, rules
from transhume.schemas import TARGETS

# User columns in which empty text means no value.
BLANK_COLUMNS = [
    "reset_pass_hash",
    "address",
    "country",
    "state",
    "city",
    "zip",
    "timezone",
    "identity_status",
    "identity_verified_at",
]


def user_keys(users: DataFrame) -> DataFrame:
    """Source id, new uuid, mail address and identity status of every user."""
    return users.select(
        "id", uuid_from("users", "id").alias("uuid"), F.col("username").alias("email"), "identity_status"
    )


def owner_uuid(keys: DataFrame, email: str) -> Column:
    """Uuid of the user with a mail address, the first by id; null when there is none."""
    return lookup.first_value(keys, F.col("email") == email, "uuid", "id")


def export_users(
    users: DataFrame,
    columns: Sequence[str] | None = TARGETS["users"],
    user_role: str = rulebook.USER_ROLE_ID,
    admin_role: str = rulebook.ADMIN_ROLE_ID,
    spread_by: Column | None = None,
    hot_rows: int = lookup.HOT_ROWS,
) -> DataFrame:
    """Users of the target platform. ``spread_by`` salts referrers of many users, and users without one."""
    nothing = F.lit(None).cast("string")
    df = conform.with_constants(users, {"uuid": uuid_from("users", "id")})
    df = conform.with_constants(df, {"role_id": rules.two_way(F.col("role") == 2, user_role, admin_role)})
    df = conform.rename(df, {"ref_by_user_id": "ref_by_user_id_old"})
    referrers = users.select("id", uuid_from("users", "id").alias("uuid"))
    df = lookup.lookup(df, referrers, "ref_by_user_id_old", "id", {"ref_by_user_id": "uuid"}, unique=True, salt_hot=spread_by, hot_rows=hot_rows)
    df = conform.rename(
        df,
        {
            "username": "email",
            "firstname": "first_name",
            "lastname": "last_name",
            "ref_link_clicks": "ref_link_count",
        },
    )
    df = conform.redact(df, ["password", "reset_pass_hash"])
    zero = F.lit(0)
    df = conform.with_defaults(
        df,
        {
            "ref_link_count": zero,
            "used_free_count": zero,
            "available_count": zero,
            "google_app_secret": nothing,
            "is_google_app_verify": zero,
            "trail_verification_status": zero,
            "ref_code": code_from("ref_code", "id"),
        },
    )
    df = conform.with_constants(df, {"status": rules.flag_if(F.col("active"), 1)})
    df = conform.copy_columns(df, {"last_login_at": "last_login", "updated_at": "created_at"})
    df = conform.with_constants(df, {"deleted_at": nothing, "dob": nothing})
    df = conform.copy_columns(df, {"affiliate_terms": "accept_affiliate_terms"})
    df = conform.with_defaults(df, {"affiliate_terms": zero})
    return conform.select_available(conform.blanks_to_null(df, BLANK_COLUMNS), columns)


def export_role_permissions(permissions: DataFrame, roles: Sequence[str] = rulebook.KEPT_ROLE_IDS) -> DataFrame:
    """Permissions of the roles that are carried over."""
    return filters.keep_members(permissions, "role_uuid", roles)


def export_default_settings(settings: DataFrame, keys: DataFrame, owner_email: str) -> DataFrame:
    """Settings rows with the owner as creator, and as last editor where that is recorded."""
    owner = owner_uuid(keys, owner_email)
    message = "no user has the owner's mail address"
    df = lookup.require_value(settings, "created_by", owner, message)
    if "updated_by" in settings.columns:
        df = lookup.require_value(df, "updated_by", owner, message)
    return conform.move_before(df, "created_by", "updated_by")
