"""All exports in the order in which they depend on each other."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from transhume.operators import lookup
from transhume.operators.audit import Counts
from transhume.plans import accounts as acc
from transhume.plans import facts, people, sales
from transhume.rulebook import AccountRules
from transhume.session import stage
from transhume.sources.tables import POSITION

# Fixed order: tables that stand alone, then what needs users, codes and groups, then
# what refers to accounts. The exports of one phase do not read each other.
PHASES = [
    ["users", "default_settings", "discount_codes", "platform_groups"],
    ["purchases", "platform_accounts"],
    [
        "account_stats",
        "platform_events",
        "breach_activities",
        "payout_requests",
        "equity_daily",
        "deals",
        "recent_deals",
        "challenge_settings",
    ],
]
ORDER = [name for phase in PHASES for name in phase]

# Tables that later exports read; they are written once and read back.
_SHARED = {"discount_codes", "platform_groups", "platform_accounts"}

# The shared tables that an export reads, at first hand.
_ACCOUNTS = {"platform_accounts"}
_READS = {
    "purchases": {"discount_codes"},
    "platform_accounts": {"platform_groups"},
    "challenge_settings": {"platform_groups", "platform_accounts"},
    **dict.fromkeys(PHASES[2][:-1], _ACCOUNTS),
}

# The columns whose matches are counted.
_FOUND = ("user_uuid", "platform_account_uuid", "platform_group_uuid", "purchase_uuid", "discount_uuid", "ref_by_user_id", "created_by")


def needed(only: Sequence[str]) -> set[str]:
    """The named exports and all that they read."""
    found = set(only)
    while more := {r for n in found for r in _READS.get(n, ())} - found:
        found |= more
    return found


@dataclass(frozen=True)
class Outcome:
    """How one export ended."""

    name: str
    ok: bool
    error: str | None = None
    counted: Callable[[], dict[str, int]] = field(default=dict, compare=False, repr=False)

    @property
    def counts(self) -> dict[str, int]:
        """Rows of each step, of what was written, and of those with a match, as the jobs that wrote it counted them.

        Waits for these jobs, so it is asked of tables that were written.
        """
        return self.counted()


class _Needed(Exception):
    """A table that an export needs is not there."""


class _Failed(Exception):
    """A table that an export reads could not be made."""


class _Tables(dict):
    """Tables by name; one that failed is not there for anyone, not even where it is optional."""

    def __init__(self, *args):
        super().__init__(*args)
        self.failed: set[str] = set()

    def __missing__(self, name: str) -> DataFrame:
        if name in self.failed:
            raise _Failed(f"needs {name}, which failed")
        raise _Needed(f"needs {name}")

    def get(self, name: str, default: DataFrame | None = None) -> DataFrame | None:
        if name in self.failed:
            raise _Failed(f"needs {name}, which failed")
        return super().get(name, default)


def run_all(
    sources: dict[str, DataFrame],
    names: AccountRules,
    owner_email: str,
    group_prefixes: Sequence[str],
    write: Callable[[DataFrame, str], DataFrame | None],
    as_of: dt.datetime,
    account_order: Sequence[str] | None = None,
    stats_last_by: Sequence[str] | None = None,
    data_last_by: Sequence[str] | None = None,
    preferred_last_by: Sequence[str] | None = None,
    deal_keys: Sequence[str] | None = None,
    equity_keys: Sequence[str] | None = None,
    stats_keys: Sequence[str] | None = None,
    keep_secrets: bool = False,
    only: Sequence[str] | None = None,
    at_once: int = 4,
    spread_by: dict[str, Column] | None = None,
    hot_rows: int = lookup.HOT_ROWS,
) -> tuple[dict[str, DataFrame], list[Outcome]]:
    """Build and write every export; one that fails does not stop the others.

    An export whose source is absent is left out, and those that can do without it are
    made all the same. What reads an export that failed fails as well and writes nothing.

    ``write(table, name)`` stores a finished table; the frame that it may give back, as the sinks of
    ``tables`` do, stands for the table from then on, so that using it does not run the export again.
    Returns the tables and the outcomes, which know the row counts of each step. ``only`` builds the named exports
    and the shared tables they read. Up to
    ``at_once`` exports of a phase run as concurrent Spark jobs, so that the last tasks
    of one leave no executors idle.

    First and last rows go by the position in the source files where a source was read with it, else by the
    columns that ``account_order``, ``stats_last_by``, ``data_last_by`` and ``preferred_last_by`` say (created_at and login,
    group, both passwords, login). ``spread_by`` names, by export, what its rows are spread by where more than ``hot_rows`` of
    them share a key.
    """
    positioned = {n for n, df in sources.items() if POSITION in df.columns}

    def order(source: str, given: Sequence[str] | None, otherwise: Sequence[str] | None) -> Sequence[str] | None:
        return given if given is not None else [POSITION] if source in positioned else otherwise

    ordered = {"accounts", "account_stats", "account_data", "preferred_logins"}
    sources = {n: df.drop(POSITION) if n in positioned - ordered else df for n, df in sources.items()}
    spread = spread_by or {}
    salt = lambda name: {"spread_by": spread.get(name), "hot_rows": hot_rows}
    counted = {name: Counts() for name in ORDER}
    src, made = _Tables(sources), _Tables()
    keys = people.user_keys(sources["users"]) if "users" in sources else None

    def need_keys() -> DataFrame:
        if keys is None:
            raise _Needed("needs users")
        return keys

    def platform_accounts() -> DataFrame:
        return acc.export_platform_accounts(
            src["accounts"],
            names,
            user_keys=keys,
            purchase_keys=sales.purchase_keys(sources["purchases"]) if "purchases" in sources else None,
            stats=sources.get("account_stats"),
            preferences=sources.get("preferred_logins"),
            account_data=sources.get("account_data"),
            groups=made.get("platform_groups"),
            order_by=order("accounts", account_order, ("created_at", "login")),
            stats_last_by=order("account_stats", stats_last_by, ("group",)),
            data_last_by=order("account_data", data_last_by, ("main_password", "investor_password")),
            preferred_last_by=order("preferred_logins", preferred_last_by, None),
            keep_secrets=keep_secrets,
            watch=counted["platform_accounts"].watch,
            **salt("platform_accounts"),
        )

    accounts = "platform_accounts"
    builders: dict[str, Callable[[], DataFrame]] = {
        "users": lambda: people.export_users(src["users"], **salt("users")),
        "default_settings": lambda: people.export_default_settings(src["default_settings"], need_keys(), owner_email),
        "discount_codes": lambda: sales.export_discount_codes(src["discount_codes"], keys, owner_email),
        "platform_groups": lambda: acc.export_platform_groups(src["platform_groups"], group_prefixes),
        "purchases": lambda: sales.export_purchases(
            src["purchases"], need_keys(), sources.get("discount_codes"), made.get("discount_codes"), **salt("purchases")
        ),
        accounts: platform_accounts,
        "account_stats": lambda: acc.export_account_stats(src["account_stats"].drop(POSITION), made[accounts], stats_keys, **salt("account_stats")),
        "platform_events": lambda: facts.export_platform_events(
            src["platform_events"], made.get(accounts), **salt("platform_events")
        ),
        "breach_activities": lambda: facts.export_breach_activities(
            src["breach_activities"], made.get(accounts), **salt("breach_activities")
        ),
        "payout_requests": lambda: sales.export_payout_requests(
            src["payout_requests"], need_keys(), made[accounts], owner_email, **salt("payout_requests")
        ),
        "equity_daily": lambda: facts.export_equity_daily(
            src["equity_daily"], made.get(accounts), equity_keys, **salt("equity_daily")
        ),
        "deals": lambda: facts.export_deals(src["deals"], made.get(accounts), deal_keys, **salt("deals")),
        "recent_deals": lambda: facts.export_recent_deals(
            src["deals"], made.get(accounts), as_of, id_keys=deal_keys, **salt("recent_deals")
        ),
        "challenge_settings": lambda: acc.export_challenge_settings(
            src["default_settings"], made["platform_groups"], made[accounts], as_of.isoformat(sep=" ")
        ),
    }

    def run(name: str) -> tuple[str, DataFrame | None, Outcome]:
        try:
            table = builders[name]()
            found = [c for c in _FOUND if c in table.columns]
            watched = counted[name].watch(table, "written", found)
            if name in _SHARED:
                table = watched = stage(watched, name)
            if only is None or name in only:
                back = write(watched, name)
                table = back if isinstance(back, DataFrame) else table
            return name, table, Outcome(name, True, counted=lambda: counted[name].taken(found))
        except _Needed as absent:  # its source is not there: what can do without it goes on
            return name, None, Outcome(name, False, str(absent))
        except Exception as error:  # an export that fails must not stop the rest
            failed.append(name)
            return name, None, Outcome(name, False, f"{type(error).__name__}: {error}")

    outcomes: list[Outcome] = []
    failed: list[str] = []
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        for phase in PHASES:
            wanted = [n for n in phase if only is None or n in needed(only)]
            for name, table, outcome in list(pool.map(run, wanted)):
                outcomes.append(outcome)
                if table is not None:
                    made[name] = table
            made.failed.update(failed)
    return dict(made), outcomes
