"""Invented source rows that hold the edge cases of every export."""

import datetime as dt

from transhume.schemas import source_schema

G = "demo\\Acme\\U-"
OWNER = "owner@example.com"
DAY = dt.datetime(2024, 1, 15)


def _table(spark, name, records):
    schema = source_schema(name)
    known = {f.name for f in schema.fields}
    for r in records:
        assert set(r) <= known, set(r) - known
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in records], schema)


def users(spark, owners=1):
    base = [
        dict(id=1, username="a@example.com", role=2, active=1, ref_by_user_id=2, address="", identity_status="completed"),
        dict(id=2, username="b@example.com", role=1, active=0, ref_by_user_id=99, address="x", identity_status=""),
        dict(id=3, username="c@example.com", password="dummy", reset_pass_hash="dummy", created_at=DAY),
    ]
    base += [dict(id=10 + i, username=OWNER, role=2, active=1) for i in range(owners)]
    return _table(spark, "users", base)


def discount_codes(spark):
    later = dt.datetime(2024, 2, 1)
    return _table(
        spark,
        "discount_codes",
        [
            dict(id=1, code="TEN", status="Active", discount=10.0, created_date=DAY, last_modified_date=later),
            dict(id=2, code="TEN", status="inactive", discount=11.0, created_date=DAY),
            dict(id=3, code=None, status="expired", discount=5.0, created_date=DAY),
            dict(id=4, code="SUM", status=None, discount=99.9, created_date=DAY, challenge_amount="[1000]"),
        ],
    )


def purchases(spark):
    return _table(
        spark,
        "purchases",
        [
            dict(id=1, user_id=1, discount_id=2, payment_method="card", created_at=DAY, discount=99.9),
            dict(id=2, user_id=77, discount_id=3, payment_method="Crypto", created_at=DAY),
            dict(id=3, user_id=None, discount_id=None, created_at=DAY, user_data='{"a": "b, c"}'),
            dict(id=4, user_id=3, discount_id=88, created_at=DAY),
        ],
    )


def platform_groups(spark):
    rows = []
    for i, stage in enumerate(["trial", "single", "double", "triple", "instant"]):
        for kind in ("standard", "aggressive"):
            rows.append(
                dict(uuid=f"g-{stage}-{kind}", name=G + "DAG-1-B", group_type="challenge", platform_name="mt5",
                     account_stage=stage, account_type=kind, initial_balance=10000.0,
                     funded_group_name=None if i == 0 else G + "NEW-1-A")
            )
    rows.append(dict(rows[0], uuid="g-other", name="demo\\Other\\U-X"))
    rows.append(dict(rows[0], uuid="g-real", group_type="competition"))
    rows.append(dict(rows[0], uuid="g-double", name="demo\\\\Acme\\U-X", initial_balance=20000.0))
    return _table(spark, "platform_groups", rows)


def accounts(spark):
    def account(login, purchase, group=G + "DAG-1-B", **more):
        base = dict(login=login, purchase_id=purchase, user_id=1, is_active=1, initial_balance=10000, account_type=0,
                    account_stages=1, created_at=DAY, target=8.0)
        return {**base, "group": group, **more}

    hour = dt.timedelta(hours=1)
    return _table(
        spark,
        "accounts",
        [
            account("D#1", 1),
            account(None, 2),
            account("100", 10),
            account("101", 10, created_at=DAY + hour),
            account("102", 20),
            account("103", 20, created_at=DAY + hour),
            account("104", 30),
            account("104", 31, created_at=DAY + hour),
            account("105", None),
            account("106", None, created_at=DAY + hour),
            account("107", 40, group=None),
            account("108", 41, group=""),
            account("109", 42, group=None),
            account("110", 43, action_type="Competition", user_id=3),
            account("111", 44, account_stages=0, account_type=1),
            account("112", 45, account_stages=2, is_active=0, trades_check=1, contract_sign_staus=1),
            account("113", 46, account_stages=3, group=G + "SAG-2-A"),
            account("114", 47, account_stages=4, group=G + "FTF-1-A", funded_at=DAY),
            account("115", 48, account_stages=9, account_type=7, group=G + "NEW-1-A", funded_at=DAY),
            account("116", 49, initial_balance=77),
            account("117", 50, group=G + "FTF-1-A", funded_at=DAY, is_active=0),
            account("118", 51, funded_at=DAY, is_active=0),
            account("119", 1, user_id=77),
        ],
    )


def preferred_logins(spark):
    rows = [dict(login="103", purchase_id=20), dict(login="999", purchase_id=10), dict(login="106", purchase_id=None)]
    return _table(spark, "preferred_logins", rows)


def account_data(spark):
    return _table(spark, "account_data", [dict(account_login="100", main_password="m", investor_password="i")])


def account_stats(spark):
    rows = [
        {"account_login": "107", "group": G + "SAG-3-A", "current_equity": 5.0, "yesterday_equity": 3.0},
        {"account_login": "108", "group": "", "current_equity": 5.0},
        {"account_login": "100", "group": None, "current_equity": 4.0, "yesterday_equity": None},
        {"account_login": "100", "group": G + "DAG-2-B", "current_equity": 6.0, "yesterday_equity": 1.5, "status": 1},
        {"account_login": "555", "group": G + "DAG-2-B"},
    ]
    return _table(spark, "account_stats", rows)


def platform_events(spark):
    at = "2024-01-15 10:00:00"
    return _table(
        spark,
        "platform_events",
        [
            dict(id=1, login="100", event="hardBreach", created_at=at),
            dict(id=2, login="0100", event="trade", created_at=at),
            dict(id=3, login=None, event="trade", created_at=at),
            dict(id=4, login="119", event=None, created_at=None),
        ],
    )


def breach_activities(spark):
    return _table(
        spark,
        "breach_activities",
        [
            dict(Id=1, account_login="100", BreachCount=2, LastBreachDate="2024-01-15 10:00:00", IsBreached=2),
            dict(Id=2, account_login="100", BreachCount=0, LastBreachDate=None, IsBreached=0),
            dict(Id=3, account_login="none", BreachCount=1, LastBreachDate="not read", IsBreached=1),
        ],
    )


def payout_requests(spark):
    return _table(
        spark,
        "payout_requests",
        [
            dict(id=1, user_id=1, program_login="100", type="affiliate", status=3, compliance_note="ok", method="bank"),
            dict(id=2, user_id=1, program_login="nobody", type="challenge", status=4),
            dict(id=3, user_id=77, program_login="100", type="affiliate", status=1),
            dict(id=4, user_id=3, program_login=None, type=None, status=None),
        ],
    )


def equity_daily(spark):
    row = dict(day="2024-01-15", created_date="2024-01-15 23:59:59", equity=1.0, balance=2.0, equity_eod_mt5=3.0)
    return _table(spark, "equity_daily", [dict(row, trading_account=a) for a in ("100", "555", None, "0100", "110")])


def deals(spark, spoiled=False):
    limit = dt.datetime(2024, 7, 1) - dt.timedelta(days=180)
    times = [str(limit), str(limit - dt.timedelta(seconds=1)), "2024-06-01T10:00:00", "n/a" if spoiled else None, None]
    rows = [
        dict(trading_account="100", deal_id=i, deal_time=t, deal_volume=1.5, dupe_detected=i % 3, deal_swap=0.0)
        for i, t in enumerate(times)
    ]
    rows.append(dict(trading_account="555", deal_id=9, deal_time="2024-06-01 10:00:00"))
    return _table(spark, "deals", rows)


def default_settings(spark):
    return _table(
        spark,
        "default_settings",
        [
            {"uuid": "s-1", "100_profit_split": True, "profit_target": 8.0, "account_leverage": 100, "created_by": "x",
             "delete_account_after_failure": 30, "delete_account_after_failure_unit": "days", "updated_by": "y"}
        ],
    )


def role_permissions(spark):
    from transhume.rulebook import KEPT_ROLE_IDS

    return _table(spark, "role_permissions", [dict(role_uuid=u) for u in (*KEPT_ROLE_IDS, "other", None)])


def everything(spark):
    return {
        f.__name__: f(spark)
        for f in (
            users, discount_codes, purchases, platform_groups, accounts, preferred_logins, account_data, account_stats,
            platform_events, breach_activities, payout_requests, equity_daily, deals, default_settings, role_permissions,
        )
    }
