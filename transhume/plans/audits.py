"""Step funnels and coverage per exported table.

Counts are taken per key before anything is joined, so a frequent key is one row by
the time it is shuffled. The results have a handful of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transhume import rulebook
from transhume.functions.text import present, text_of
from transhume.operators import audit, dedup
from transhume.plans.accounts import GROUP_KEYS, surviving_accounts, with_known_group


def _n(df: DataFrame) -> Column:
    """Row count as a scalar subquery."""
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def coverage(df: DataFrame, on: str, dim: DataFrame, key: str, text: bool = False) -> DataFrame:
    """Rows in total, and with and without a partner in the other table."""
    left = text_of(F.col(on)) if text else F.col(on)
    right = text_of(F.col(key)) if text else F.col(key)
    per_key = df.groupBy(left.alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    known = dim.select(right.alias("__d")).filter(F.col("__d").isNotNull()).distinct()
    joined = per_key.join(known, F.col("__k") == F.col("__d"), "left")
    total, hit = F.sum("__n"), F.sum(F.when(F.col("__d").isNotNull(), F.col("__n")))
    return joined.agg(
        F.coalesce(total, F.lit(0)).cast("long").alias("total"),
        F.coalesce(hit, F.lit(0)).cast("long").alias("with_partner"),
        (F.coalesce(total, F.lit(0)) - F.coalesce(hit, F.lit(0))).cast("long").alias("without_partner"),
    )


def summary(original: DataFrame, final: DataFrame) -> DataFrame:
    """Retention of an export together with its number of columns."""
    return audit.retention(original, final).withColumn("total_columns", F.lit(len(final.columns)))


def audit_accounts(
    accounts: DataFrame,
    stats: DataFrame | None,
    groups: DataFrame,
    final: DataFrame,
    preferences: DataFrame | None = None,
    order_by: Sequence[str] = ("created_at", "login"),
    foreign_prefix: str = rulebook.FOREIGN_LOGIN_PREFIX,
) -> DataFrame:
    """Accounts after each step from source to export.

    Reads narrow columns three times (all rows, purchases, survivors) rather than the
    whole pipeline once per step.
    """
    needed = accounts.select(*dict.fromkeys(["login", "purchase_id", "group", *order_by]))
    own = ~F.col("login").startswith(F.lit(foreign_prefix))
    foreign = F.col("login").startswith(F.lit(foreign_prefix))
    scanned = needed.agg(
        F.count(F.lit(1)).alias("n_all"), audit.count_if(own).alias("n_own"), audit.count_if(foreign).alias("n_foreign")
    )
    purchases = needed.filter(own).select("purchase_id").distinct()
    kept = with_known_group(
        surviving_accounts(needed, preferences, order_by, foreign_prefix=foreign_prefix), stats, keep_unknown=True
    )
    last = kept.agg(
        F.struct(
            F.count(F.lit(1)).alias("logins"), audit.count_if(present(F.col("group"))).alias("grouped")
        ).alias("s")
    ).scalar()
    counts = (
        scanned.withColumn("n_purchases", _n(purchases))
        .withColumn("last", last)
        .withColumn("n_final", _n(final))
        .withColumn("n_combos", _n(dedup.distinct_rows(groups, GROUP_KEYS)))
        .select("*", F.col("last.logins").alias("n_logins"), F.col("last.grouped").alias("n_grouped"))
    )
    steps = [
        ("Foreign platform filtering", "not accounts of this platform", "n_all", "n_own"),
        ("Purchase deduplication", "purchase must be unique", "n_own", "n_purchases"),
        ("Login deduplication", "login must be unique", "n_purchases", "n_logins"),
        ("Group filtering", "accounts need a group", "n_logins", "n_grouped"),
        ("Group combination filtering", "only known combinations are kept", "n_grouped", "n_final"),
    ]
    c = F.col
    details = {
        steps[0][0]: {"removed": c("n_foreign"), "pattern": F.lit(f"{foreign_prefix}*")},
        steps[1][0]: {"duplicates": c("n_own") - c("n_purchases"), "unique": c("n_purchases")},
        steps[2][0]: {"duplicates": c("n_purchases") - c("n_logins"), "unique": c("n_logins")},
        steps[3][0]: {"with_group": c("n_grouped"), "without_group": c("n_logins") - c("n_grouped")},
        steps[4][0]: {"valid_combinations": c("n_combos"), "removed": c("n_grouped") - c("n_final")},
    }
    return audit.funnel_rows(counts, steps, details)


def audit_discount_codes(codes: DataFrame, final: DataFrame) -> DataFrame:
    counts = audit.duplicate_counts(codes, ["code"]).withColumn("n_final", _n(final))
    step = ("Code deduplication", "code must be unique", "total", "n_final")
    details = {step[0]: {"duplicates": F.col("duplicates"), "unique": F.col("distinct_keys")}}
    return audit.funnel_rows(counts, [step], details)


def audit_purchases(purchases: DataFrame, users: DataFrame, codes: DataFrame, final: DataFrame) -> DataFrame:
    """Coverage of buyers and discounts. Neither removes purchases."""
    buyers = coverage(purchases, "user_id", users, "id").select(F.struct("*").alias("b")).scalar()
    discounts = coverage(purchases, "discount_id", codes, "id").select(F.struct("*").alias("d")).scalar()
    counts = final.agg(F.count(F.lit(1)).alias("n_final")).withColumns({"b": buyers, "d": discounts})
    counts = counts.select("*", F.col("b.total").alias("n_all"))
    steps = [
        ("User mapping", "purchases keep an unknown buyer as null", "n_all", "n_final"),
        ("Discount mapping", "discounts are optional", "n_final", "n_final"),
    ]
    details = {
        steps[0][0]: {"with_user": F.col("b.with_partner"), "without_user": F.col("b.without_partner")},
        steps[1][0]: {"with_discount": F.col("d.with_partner"), "without_discount": F.col("d.without_partner")},
    }
    return audit.funnel_rows(counts, steps, details)


def audit_facts(facts: DataFrame, accounts: DataFrame, login: str = "trading_account") -> DataFrame:
    """Rows that stay because their account is known (equity and deals alike)."""
    counts = coverage(facts, login, accounts, "platform_login_id", text=True)
    step = ("Account mapping", "account must exist", "total", "with_partner")
    details = {step[0]: {"with_account": F.col("with_partner"), "without_account": F.col("without_partner")}}
    return audit.funnel_rows(counts, [step], details)


def audit_settings(groups: DataFrame, accounts: DataFrame) -> DataFrame:
    """Settings generated for groups, then for accounts (removed counts are negative)."""
    counts = groups.agg(F.count(F.lit(1)).alias("n_groups")).withColumn("n_accounts", _n(accounts))
    counts = counts.select("*", F.lit(0).cast("long").alias("n0"), (F.col("n_groups") + F.col("n_accounts")).alias("n_both"))
    steps = [
        ("Groups", "each group needs settings", "n0", "n_groups"),
        ("Accounts", "each account needs settings", "n_groups", "n_both"),
    ]
    details = {
        "Groups": {"processed": F.col("n_groups")},
        "Accounts": {"processed": F.col("n_accounts")},
    }
    return audit.funnel_rows(counts, steps, details)


def settings_summary(settings: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Settings per kind of owner, and how many have each flag set."""
    conditions: dict[str, Column] = {
        "for_groups": F.col("platform_group_uuid").isNotNull(),
        "for_accounts": F.col("platform_account_uuid").isNotNull(),
    }
    for f in flags:
        conditions[f"{f}_true"] = F.col(f"`{f}`")
        conditions[f"{f}_false"] = ~F.coalesce(F.col(f"`{f}`"), F.lit(False))
    return audit.flag_counts(settings, conditions)


def account_distributions(accounts: DataFrame) -> DataFrame:
    """Phase, status and funded status with their shares."""
    return audit.distribution(accounts, ["current_phase", "status", "funded_status"])
