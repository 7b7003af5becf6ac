import datetime as dt

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests import migration_rows as given
from transhume import rulebook
from transhume.operators import filters
from transhume.plans import accounts as acc
from transhume.plans import audits, everything, facts, people, sales
from transhume.schemas import TARGETS, source_schema
from transhume.sources import dump, tables

FAILURE = (PySparkException, Py4JJavaError)
NAMES = rulebook.AccountRules("demo\\Acme")
PREFIXES = ["demo\\Acme", "demo\\\\Acme"]


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def keys(spark):
    return people.user_keys(given.users(spark)).cache()


@pytest.fixture(scope="module")
def uuids(keys):
    return {r.id: r.uuid for r in keys.collect()}


@pytest.fixture(scope="module")
def groups(spark):
    return acc.export_platform_groups(given.platform_groups(spark), PREFIXES).cache()


def build_accounts(spark, groups, keys, **options):
    settings = dict(
        user_keys=keys,
        purchase_keys=sales.purchase_keys(given.purchases(spark)),
        stats=given.account_stats(spark),
        preferences=given.preferred_logins(spark),
        account_data=given.account_data(spark),
        groups=groups,
    )
    return acc.export_platform_accounts(given.accounts(spark), NAMES, **{**settings, **options})


@pytest.fixture(scope="module")
def accounts(spark, groups, keys):
    return build_accounts(spark, groups, keys).cache()


# -- people ------------------------------------------------------------------------------


def test_users(spark, uuids):
    df = people.export_users(given.users(spark))
    assert df.columns == TARGETS["users"]
    got = by(df, "email")
    a, b, c = got["a@example.com"], got["b@example.com"], got["c@example.com"]
    assert (a["ref_by_user_id"], b["ref_by_user_id"], c["ref_by_user_id"]) == (uuids[2], None, None)
    assert (a["role_id"], b["role_id"], c["role_id"]) == (
        rulebook.USER_ROLE_ID,
        rulebook.ADMIN_ROLE_ID,
        rulebook.ADMIN_ROLE_ID,
    )
    assert (a["status"], b["status"], c["status"]) == (1, 0, 0)
    assert (a["address"], b["address"], c["address"], b["identity_status"]) == (None, "x", None, None)
    assert (c["password"], c["reset_pass_hash"], c["deleted_at"], c["dob"]) == (None, None, None, None)
    assert c["updated_at"] == given.DAY
    assert len({r["uuid"] for r in got.values()}) == len(got)


def test_absent_user_columns_get_defaults(spark):
    df = given.users(spark).drop("used_free_count", "ref_code", "ref_link_clicks", "accept_affiliate_terms")
    row = people.export_users(df).first().asDict()
    assert (row["used_free_count"], row["ref_link_count"], row["affiliate_terms"]) == (0, 0, 0)
    assert len(row["ref_code"]) == 8
    assert "accept_affiliate_terms" not in row


@pytest.mark.parametrize("owners, found", [(1, True), (2, True), (0, False)])
def test_owner_of_settings_and_codes(spark, owners, found):
    keys = people.user_keys(given.users(spark, owners))
    codes = sales.export_discount_codes(given.discount_codes(spark), keys, given.OWNER)
    first = {r.id: r.uuid for r in keys.collect()}.get(10)
    assert {r.created_by for r in codes.collect()} == {first if found else None}
    settings = people.export_default_settings(given.default_settings(spark), keys, given.OWNER)
    if not found:
        with pytest.raises(FAILURE):
            settings.collect()
        return
    row = settings.first()
    assert row.created_by == row.updated_by == first
    assert settings.columns.index("created_by") == settings.columns.index("updated_by") - 1


def test_settings_without_editor_keep_their_columns(spark, keys):
    settings = given.default_settings(spark).drop("updated_by", "created_by")
    df = people.export_default_settings(settings, keys, given.OWNER)
    assert df.columns == [*settings.columns, "created_by"]


def test_role_permissions(spark):
    got = {r.role_uuid for r in people.export_role_permissions(given.role_permissions(spark)).collect()}
    assert got == set(rulebook.KEPT_ROLE_IDS)


# -- sales -------------------------------------------------------------------------------


def test_discount_codes(spark, keys):
    df = sales.export_discount_codes(given.discount_codes(spark), keys, given.OWNER)
    assert df.columns == TARGETS["discount_codes"]
    got = by(df, "code")
    assert set(got) == {"TEN", None, "SUM"}
    assert (got["TEN"]["discount"], got["TEN"]["status"], got["SUM"]["status"]) == (10.0, "active", "inactive")
    assert got["TEN"]["updated_at"] == dt.datetime(2024, 2, 1) and got["SUM"]["updated_at"] == given.DAY
    assert got["SUM"]["commission_percentage"] == 99.9 and got["SUM"]["challenge_amount"] == "[1000]"
    assert {r["type"] for r in got.values()} == {"admin"}
    without = sales.export_discount_codes(given.discount_codes(spark), None, given.OWNER)
    assert {r.created_by for r in without.collect()} == {None}


def test_purchases(spark, keys, uuids):
    codes = given.discount_codes(spark)
    exported = sales.export_discount_codes(codes, keys, given.OWNER)
    by_code = {r.code: r.uuid for r in exported.collect()}
    df = sales.export_purchases(given.purchases(spark), keys, codes, exported)
    assert df.columns == TARGETS["purchases"]
    ids = {r.uuid: r.id for r in sales.purchase_keys(given.purchases(spark)).collect()}
    got = {ids[r.uuid]: r for r in df.collect()}
    assert {i: r.user_uuid for i, r in got.items()} == {1: uuids[1], 2: None, 3: None, 4: uuids[3]}
    assert {i: r.discount_uuid for i, r in got.items()} == {1: by_code["TEN"], 2: by_code[None], 3: None, 4: None}
    assert (got[1].payment_method, got[2].payment_method) == ("CARD", "CRYPTO")
    assert got[3].user_data == '{"a": "b, c"}' and got[1].purchase_type == "challenge"
    assert got[1].updated_at == given.DAY
    without = sales.export_purchases(given.purchases(spark), keys)
    assert without.columns == TARGETS["purchases"] and {r.discount_uuid for r in without.collect()} == {None}


def test_payouts(spark, keys, accounts, uuids):
    df = sales.export_payout_requests(given.payout_requests(spark), keys, accounts, given.OWNER)
    assert df.columns == TARGETS["payout_requests"]
    got = sorted(df.collect(), key=lambda r: (r.user_uuid, str(r.type)))
    first = next(r for r in got if r.type == "affiliate")
    other = next(r for r in got if r.type == "challenge")
    third = next(r for r in got if r.type is None)
    assert len(got) == 3 and third.user_uuid == uuids[3]
    assert (first.status, other.status, third.status) == (4, 4, None)
    assert first.payout_id.startswith("AFF-") and len(first.payout_id) == 12 and other.payout_id is None
    assert first.platform_account_uuid is not None and other.platform_account_uuid is None
    assert first.note == "ok" and {r.note_created_by for r in got} == {uuids[10]}


# -- accounts ------------------------------------------------------------------------------


def test_groups(groups):
    got = {r.uuid for r in groups.collect()}
    assert "g-other" not in got and "g-real" not in got and "g-double" in got
    assert {r.platform_name for r in groups.collect()} == {"MT5"}


def test_surviving_accounts_with_and_without_preferences(spark):
    def logins(preferences):
        return sorted(r.login for r in acc.surviving_accounts(given.accounts(spark), preferences).collect())

    rest = [str(n) for n in range(107, 120)]
    assert logins(None) == ["100", "102", "104", "105", *rest]
    assert logins(given.preferred_logins(spark)) == ["100", "103", "104", "105", *rest]


def test_platform_accounts(spark, accounts, uuids):
    assert accounts.columns == TARGETS["platform_accounts"]
    got = by(accounts, "platform_login_id")
    # 109 has no group anywhere, 108 only blanks, 116 no combination.
    assert set(got) == {"100", "103", "104", "105", "107", *(str(n) for n in (*range(110, 116), *range(117, 120)))}
    assert {r["main_password"] for r in got.values()} == {None}
    state = {k: (r["current_phase"], r["status"], r["funded_status"]) for k, r in got.items()}
    assert state["100"] == (1, 1, 0) and state["107"] == (3, 1, 0) and state["113"] == (2, 1, 0)
    assert state["114"] == (0, 1, 1) and state["115"] == (0, 1, 1)
    assert state["117"] == (1, None, None) and state["118"] == (1, 0, 2)
    target = {k: r["remote_group_name"][-7:] for k, r in got.items()}
    assert (target["110"], target["114"], target["100"]) == ("COM-1-B", "FND-1-B", "EVL-1-B")
    assert got["111"]["platform_group_uuid"] == "g-trial-aggressive"
    assert got["115"]["platform_group_uuid"] == "g-trial-standard"
    assert got["112"]["platform_group_uuid"] == "g-double-standard"
    assert (got["112"]["is_trades_check"], got["112"]["is_trade_agreement"], got["100"]["is_trades_check"]) == (1, 1, 0)
    assert (got["100"]["user_uuid"], got["119"]["user_uuid"], got["110"]["user_uuid"]) == (uuids[1], None, uuids[3])
    assert (got["100"]["is_kyc"], got["110"]["is_kyc"], got["119"]["is_kyc"]) == (1, 0, 0)
    assert got["119"]["purchase_uuid"] is not None and got["100"]["purchase_uuid"] is None
    assert got["114"]["updated_at"] == given.DAY and got["100"]["profit_target"] == 8.0
    assert {r["action_type"] for r in got.values()} == {"challenge"}
    assert len({r["uuid"] for r in got.values()}) == len(got)


def test_salting_and_kept_null_purchases(spark, groups, keys, accounts):
    salted = build_accounts(spark, groups, keys, spread_by=F.col("login"), hot_rows=3)
    assert sorted(map(str, salted.collect())) == sorted(map(str, accounts.collect()))
    kept = build_accounts(spark, groups, keys, spread_by=F.col("login"), hot_rows=3, null_purchases="keep")
    assert {r.platform_login_id for r in kept.collect()} - {r.platform_login_id for r in accounts.collect()} == {"106"}
    payouts = given.payout_requests(spark)
    plain = sales.export_payout_requests(payouts, keys, accounts, given.OWNER)
    spread = sales.export_payout_requests(payouts, keys, accounts, given.OWNER, spread_by=F.col("id"), hot_rows=1)
    assert sorted(map(str, plain.collect())) == sorted(map(str, spread.collect()))


def test_secrets_only_on_request(spark, groups, keys):
    kept = by(build_accounts(spark, groups, keys, keep_secrets=True), "platform_login_id")
    assert (kept["100"]["main_password"], kept["100"]["investor_password"]) == ("m", "i")
    assert kept["103"]["main_password"] is None


def test_accounts_from_the_account_table_alone(spark):
    df = acc.export_platform_accounts(given.accounts(spark), NAMES)
    assert df.columns == TARGETS["platform_accounts"]
    got = by(df, "platform_login_id")
    assert "107" not in got and "116" in got
    assert {(r["user_uuid"], r["purchase_uuid"], r["platform_group_uuid"], r["is_kyc"]) for r in got.values()} == {
        (None, None, None, 0)
    }
    assert got["114"]["current_phase"] == 0 and got["115"]["status"] == 2


def test_repeated_group_combinations_are_refused(spark, groups, keys):
    with pytest.raises(FAILURE, match="repeated keys"):
        build_accounts(spark, groups.union(groups), keys).collect()


def test_building_the_accounts_starts_no_job(spark, groups, keys):
    spark.sparkContext.setJobGroup("building", "no job is expected")
    try:
        built = build_accounts(spark, groups, keys)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
        assert built.count() > 0
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) != []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_zero_dates_pass_through_as_text(spark, tmp_path):
    """A column that is carried as it is may be read as text, zero dates included."""
    rows = given.users(spark).limit(2)
    path = str(tmp_path / "users")
    tables.write_csv(rows.withColumn("created_at", F.lit("0000-00-00 00:00:00")), path)
    back = tables.read_csv(spark, path, rows.schema, overrides={"created_at": "string"}, checked=True)
    assert {r.created_at for r in people.export_users(back).collect()} == {"0000-00-00 00:00:00"}


def test_account_stats(spark, accounts):
    df = acc.export_account_stats(given.account_stats(spark), accounts)
    assert df.columns == TARGETS["account_stats"]
    got = df.collect()
    assert sorted((r.current_equity, r.current_profit) for r in got) == [(4.0, None), (5.0, 2.0), (6.0, 4.5)]
    assert len({r.uuid for r in got}) == 3 and {r.lowest_watermark for r in got} == {0.0}
    assert all(r.platform_account_uuid and r.platform_group_uuid for r in got)
    grouped_only = accounts.withColumn("platform_group_uuid", accounts["reason"])
    assert acc.export_account_stats(given.account_stats(spark), grouped_only).count() == 0


def test_challenge_settings(spark, groups, accounts):
    df = acc.export_challenge_settings(given.default_settings(spark), groups, accounts, "2024-06-01 12:00:00")
    assert df.columns == TARGETS["challenge_settings"]
    got = df.collect()
    assert len(got) == groups.count() + accounts.count() == len({r.uuid for r in got})
    assert {r.platform_group_uuid for r in got} - {None} == {r.uuid for r in groups.collect()}
    assert {r.platform_account_uuid for r in got} - {None} == {r.uuid for r in accounts.collect()}
    assert all((r.platform_group_uuid is None) != (r.platform_account_uuid is None) for r in got)
    row = got[0].asDict()
    assert row["100_profit_split"] is True and row["profit_target"] == "8.0" and row["account_leverage"] == 100
    assert row["created_at"] == row["updated_at"] == dt.datetime(2024, 6, 1, 12)


def test_setting_defaults_where_the_template_lacks_a_column(spark, groups, accounts):
    bare = given.default_settings(spark).select("uuid", "breach_type")
    row = acc.export_challenge_settings(bare, groups, accounts).first().asDict()
    assert (row["requires_stop_loss"], row["visible_on_leaderboard"], row["double_leverage"]) == (True, True, False)
    assert (row["profit_target"], row["max_drawdown"], row["withdraw_within"]) == ("", 0, None)
    with pytest.raises(FAILURE):
        acc.export_challenge_settings(bare.limit(0), groups, accounts).collect()


# -- facts ---------------------------------------------------------------------------------


def test_events(spark, accounts, uuids):
    df = facts.export_platform_events(given.platform_events(spark), accounts)
    assert df.columns == TARGETS["platform_events"]
    got = by(df, "event")
    assert set(got) == {"hardBreached", None}
    first = got["hardBreached"]
    assert (first["reason"], first["user_uuid"]) == ("hardBreached", uuids[1])
    assert first["created_at"] == first["updated_at"] == dt.datetime(2024, 1, 15, 10)
    assert got[None]["user_uuid"] is None and got[None]["created_at"] is None
    alone = facts.export_platform_events(given.platform_events(spark), None)
    assert alone.count() == 4 and {r.platform_account_uuid for r in alone.collect()} == {None}


def test_event_times_are_strict(spark):
    events = given.platform_events(spark).replace("2024-01-15 10:00:00", "2024-01-15T10:00:00", ["created_at"])
    with pytest.raises(FAILURE):
        facts.export_platform_events(events, None).collect()


def test_breaches(spark, accounts):
    df = facts.export_breach_activities(given.breach_activities(spark), accounts)
    assert df.columns == TARGETS["breach_activities"]
    got = by(df, "breach_count")
    assert {k: (r["is_breached"], r["last_breach_date"]) for k, r in got.items()} == {
        2: (True, dt.datetime(2024, 1, 15, 10)),
        0: (False, None),
    }
    assert len({r["id"] for r in got.values()}) == 2


def test_equity(spark, accounts):
    df = facts.export_equity_daily(given.equity_daily(spark), accounts)
    assert df.columns == TARGETS["equity_daily"]
    got = df.collect()
    assert len(got) == 2 == len({r.id for r in got})
    assert {(r.day, r.created_date) for r in got} == {(dt.date(2024, 1, 15), dt.datetime(2024, 1, 15, 23, 59, 59))}
    assert facts.export_equity_daily(given.equity_daily(spark), None).count() == 0
    with pytest.raises(ValueError):
        facts.export_equity_daily(given.equity_daily(spark).drop("balance"), accounts)
    spoiled = given.equity_daily(spark).replace("2024-01-15", "15.01.2024", ["day"])
    with pytest.raises(FAILURE):
        facts.export_equity_daily(spoiled, accounts).collect()


def test_deals_strict_and_recent(spark, accounts):
    df = facts.export_deals(given.deals(spark), accounts, id_keys=["deal_id"])
    assert df.columns == TARGETS["deals"]
    assert {r.deal_id: r.dupe_detected for r in df.collect()} == {0: False, 1: True, 2: True, 3: False, 4: True}
    with pytest.raises(FAILURE):
        facts.export_deals(given.deals(spark, spoiled=True), accounts).collect()
    recent = facts.export_recent_deals(given.deals(spark, spoiled=True), accounts, dt.datetime(2024, 7, 1))
    assert recent.columns == TARGETS["deals"]
    assert sorted(r.deal_id for r in recent.collect()) == [0, 2]
    salted = facts.export_deals(given.deals(spark), accounts, id_keys=["deal_id"], spread_by=F.col("deal_id"))
    assert sorted(map(str, salted.collect())) == sorted(map(str, df.collect()))


def test_slice_of_one_account(spark, accounts):
    df = facts.export_deals(given.deals(spark), accounts)
    one = df.first().platform_account_uuid
    assert facts.slice_deals(df, one).count() == 5
    assert facts.slice_deals(df, "nobody").count() == 0


def test_empty_facts(spark, accounts):
    for name, export in (("deals", facts.export_deals), ("equity_daily", facts.export_equity_daily)):
        empty = spark.createDataFrame([], source_schema(name))
        assert export(empty, accounts).collect() == []


# -- audits ----------------------------------------------------------------------------------


def balanced(steps):
    for before, after in zip(steps, steps[1:]):
        assert before.records_after == after.records_before
    assert all(r.records_before - r.records_after == r.records_removed for r in steps)
    return [r.records_after for r in steps]


def test_account_audit(spark, groups, accounts):
    steps = audits.audit_accounts(
        given.accounts(spark), given.account_stats(spark), groups, accounts, given.preferred_logins(spark)
    ).collect()
    assert steps[0].records_before == given.accounts(spark).count()
    assert balanced(steps) == [21, 18, 17, 15, 14]
    assert steps[0].details == {"removed": "1", "pattern": "D#*"}
    assert steps[1].details == {"duplicates": "3", "unique": "18"}
    assert steps[4].details["valid_combinations"] == "11"


def test_other_audits(spark, keys, groups, accounts):
    codes = given.discount_codes(spark)
    final = sales.export_discount_codes(codes, keys, given.OWNER)
    assert balanced(audits.audit_discount_codes(codes, final).collect()) == [3]
    bought = sales.export_purchases(given.purchases(spark), keys)
    steps = audits.audit_purchases(given.purchases(spark), given.users(spark), codes, bought).collect()
    assert balanced(steps) == [4, 4]
    assert steps[0].details == {"with_user": "2", "without_user": "2"}
    assert steps[1].details == {"with_discount": "2", "without_discount": "2"}
    assert balanced(audits.audit_facts(given.equity_daily(spark), accounts).collect()) == [2]
    assert balanced(audits.audit_facts(given.deals(spark), accounts).collect()) == [5]
    settings = audits.audit_settings(groups, accounts).collect()
    assert balanced(settings) == [11, 25]
    made = acc.export_challenge_settings(given.default_settings(spark), groups, accounts)
    row = audits.settings_summary(made, ["100_profit_split", "requires_stop_loss"]).first().asDict()
    assert (row["total"], row["for_groups"], row["for_accounts"]) == (25, 11, 14)
    assert (row["100_profit_split_true"], row["requires_stop_loss_true"], row["requires_stop_loss_false"]) == (25, 0, 25)
    summary = audits.summary(given.accounts(spark), accounts).first()
    assert (summary.final_records, summary.total_columns, summary.retention_rate) == (14, 30, 60.87)


# -- everything --------------------------------------------------------------------------------


def run(spark, sources, write=lambda df, name: df.collect(), **options):
    return everything.run_all(
        sources, NAMES, given.OWNER, PREFIXES, write, dt.datetime(2024, 7, 1), deal_keys=["deal_id"], **options
    )


def test_all_exports_to_csv(spark, tmp_path):
    made, outcomes = run(
        spark, given.everything(spark), lambda df, name: tables.write_csv(df, str(tmp_path / name))
    )
    assert [o.name for o in outcomes] == everything.ORDER
    assert [o for o in outcomes if not o.ok] == []
    for name in everything.ORDER:
        back = tables.read_csv(spark, str(tmp_path / name), made[name].schema, multiline=True)
        assert back.columns == made[name].columns
        assert back.count() == made[name].count() > 0
    accounts = {r.uuid for r in made["platform_accounts"].collect()}
    for name in ("account_stats", "platform_events", "breach_activities", "equity_daily", "deals", "recent_deals"):
        assert {r.platform_account_uuid for r in made[name].collect()} <= accounts
    people_ = {r.uuid for r in made["users"].collect()}
    assert {r.user_uuid for r in made["platform_accounts"].collect()} - {None} <= people_


def test_one_failure_does_not_stop_the_rest(spark):
    sources = given.everything(spark)
    del sources["purchases"]
    sources["platform_events"] = sources["platform_events"].drop("event")
    _, outcomes = run(spark, sources)
    failed = {o.name: o.error for o in outcomes if not o.ok}
    assert set(failed) == {"purchases", "platform_events"}
    assert "needs purchases" in failed["purchases"]


def test_without_accounts_the_dependents_say_so(spark):
    sources = given.everything(spark)
    del sources["accounts"]
    sources["breach_activities"] = sources["breach_activities"].filter("Id < 3")
    made, outcomes = run(spark, sources)
    failed = {o.name for o in outcomes if not o.ok}
    assert failed == {"platform_accounts", "account_stats", "payout_requests", "challenge_settings"}
    assert made["deals"].count() == 0 and made["platform_events"].count() == 4


@pytest.mark.parametrize(
    ("source", "dependents"),
    [
        ("accounts", {"account_stats", "platform_events", "breach_activities", "payout_requests", "equity_daily", "deals", "recent_deals", "challenge_settings"}),
        ("discount_codes", {"purchases"}),
        ("platform_groups", {"platform_accounts"}),
    ],
)
def test_what_reads_a_failed_export_fails_too(spark, source, dependents):
    sources, written = given.everything(spark), []
    broken = F.raise_error(F.lit("broken source"))
    sources[source] = sources[source].withColumns({c: broken.cast(t) for c, t in sources[source].dtypes})
    made, outcomes = run(spark, sources, lambda df, name: written.append((name, df.count())))
    upstream = {"accounts": "platform_accounts"}.get(source, source)
    failed = {o.name: o.error for o in outcomes if not o.ok}
    assert {upstream, *dependents} <= set(failed)
    assert all(f"needs {upstream}, which failed" in failed[d] for d in dependents)
    assert not {n for n, _ in written} & set(failed)


def test_single_export_brings_what_it_reads(spark):
    written = []
    made, outcomes = run(spark, given.everything(spark), lambda df, name: written.append(name), only=["deals"])
    assert written == ["deals"]
    assert {o.name for o in outcomes} == {"platform_groups", "platform_accounts", "deals"}


# -- counts, positions, sinks --------------------------------------------------------------------


def test_counts_come_with_the_jobs_that_write(spark, tmp_path):
    sources = given.everything(spark)
    made, outcomes = run(spark, sources, tables.parquet_sink(str(tmp_path)))
    counts = {o.name: o.counts for o in outcomes}
    for name, table in made.items():
        assert counts[name]["written"] == table.count()
        for c in ("user_uuid", "platform_account_uuid"):
            if c in table.columns:
                assert counts[name][f"{c}_matched"] == table.where(F.col(c).isNotNull()).count()
    accounts = sources["accounts"]
    steps = counts["platform_accounts"]
    assert steps["read"] == accounts.count() >= steps["own"] >= steps["one_per_purchase"] >= steps["one_per_login"]
    assert steps["own"] == filters.exclude_prefix(accounts, "login", rulebook.FOREIGN_LOGIN_PREFIX).count()
    survivors = acc.surviving_accounts(accounts, sources.get("preferred_logins"))
    assert steps["one_per_login"] == survivors.count()
    assert steps["with_group"] >= steps["with_group_uuid"] == steps["written"]


def test_tables_are_reads_of_what_was_written(spark, tmp_path):
    made, _ = run(spark, given.everything(spark), tables.csv_sink(str(tmp_path)), only=["users", "deals"])
    for name in ("users", "deals"):
        assert all(str(tmp_path) in f for f in made[name].inputFiles())
    assert made["deals"].collect() == made["deals"].collect()


def test_only_builds_no_table_that_it_does_not_need(spark):
    _, outcomes = run(spark, given.everything(spark), only=["users"])
    assert [o.name for o in outcomes] == ["users"]
    _, outcomes = run(spark, given.everything(spark), only=["purchases"])
    assert [o.name for o in outcomes] == ["discount_codes", "purchases"]


def test_a_failing_rewrite_leaves_the_earlier_files(spark, tmp_path):
    path = str(tmp_path / "deep" / "users")
    good = spark.range(5).selectExpr("id", "cast(id as string) AS name")
    bad = spark.range(8, numPartitions=8).select("id", F.when(F.col("id") == 7, F.raise_error(F.lit("broken")).cast("string")).alias("name"))
    for write, read in ((tables.write_parquet, spark.read.parquet), (tables.write_csv, lambda p: tables.read_csv(spark, p, "id long, name string"))):
        write(good, f"{path}_{write.__name__}")
        with pytest.raises(Exception, match="broken"):
            write(bad, f"{path}_{write.__name__}")
        assert read(f"{path}_{write.__name__}").count() == 5
        write(good.limit(2), f"{path}_{write.__name__}")
        assert read(f"{path}_{write.__name__}").count() == 2
    assert sorted(f.name for f in (tmp_path / "deep").iterdir()) == ["users_write_csv", "users_write_parquet"]


def test_file_order_decides_first_and_last(spark, tmp_path):
    """Of repeated logins the first account stays and the later password counts, as the files have them."""
    sources = given.everything(spark)
    login = acc.surviving_accounts(sources["accounts"]).where("login IS NOT NULL").first().login
    for k, password in enumerate(["old_z", "new_a"]):
        (tmp_path / "data").mkdir(exist_ok=True)
        (tmp_path / "data" / f"part-{k}.csv").write_text(f"account_login,main_password,investor_password\n{login},{password},x\n")
    back = tables.read_csv(spark, str(tmp_path / "data"), "account_login string, main_password string, investor_password string", position=True)
    sources["account_data"] = back
    made, _ = run(spark, sources, tables.parquet_sink(str(tmp_path / "out")), keep_secrets=True)
    assert {r.main_password for r in made["platform_accounts"].collect() if r.platform_login_id == login} <= {"new_a"}
    rows = sources["accounts"].where(F.col("login") == login).limit(1)
    names = rows.columns
    for k, at in enumerate(["2022-02-02T00:00:00.000000", "2021-01-01T00:00:00.000000"]):
        tables.write_csv(rows.withColumn("created_at", F.lit(at).cast(rows.schema["created_at"].dataType)).coalesce(1), str(tmp_path / f"accounts{k}"))
        (tmp_path / "accounts").mkdir(exist_ok=True)
        next((tmp_path / f"accounts{k}").glob("*.csv")).replace(tmp_path / "accounts" / f"part-{k}.csv")
    sources["accounts"] = tables.read_csv(spark, str(tmp_path / "accounts"), rows.schema, position=True)
    assert sources["accounts"].columns == [*names, tables.POSITION]
    first = acc.surviving_accounts(sources["accounts"], order_by=[tables.POSITION]).collect()
    earliest = acc.surviving_accounts(sources["accounts"]).collect()
    assert [str(r.created_at)[:4] for r in first] == ["2022"] and [str(r.created_at)[:4] for r in earliest] == ["2021"]


def test_dump_rows_know_their_place(spark, tmp_path):
    (tmp_path / "a.sql").write_text("CREATE TABLE t (a int);\nINSERT INTO t VALUES (5),(3);\nINSERT INTO t VALUES (4);\n")
    (tmp_path / "b.sql").write_text("INSERT INTO t VALUES (1);\n")
    got = dump.load_dump(spark, str(tmp_path), {"t": "a int"}, position=True)["t"]
    assert [r.a for r in got.orderBy(tables.POSITION).collect()] == [5, 3, 4, 1]


def test_salted_exports_are_the_plain_ones(spark, tmp_path):
    sources = given.everything(spark)
    plain, _ = run(spark, sources, tables.parquet_sink(str(tmp_path / "plain")), only=["users", "account_stats", "deals"], stats_keys=["src_id"] if "src_id" in sources["account_stats"].columns else None)
    spread = {n: F.lit(1) for n in ("users", "account_stats", "deals")}
    salted, outcomes = run(spark, sources, tables.parquet_sink(str(tmp_path / "salted")), only=list(spread), spread_by=spread, hot_rows=1, stats_keys=["src_id"] if "src_id" in sources["account_stats"].columns else None)
    assert all(o.ok for o in outcomes)
    for name in ("users", "deals"):
        assert sorted(map(repr, salted[name].collect())) == sorted(map(repr, plain[name].collect()))
    assert salted["account_stats"].count() == plain["account_stats"].count()
