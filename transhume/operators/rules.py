"""Business rules as column expressions. Names and codes come in as arguments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from transhume.functions.text import blank_to_null


def two_way(condition: Column, yes: object, no: object) -> Column:
    """One of two values; a null condition counts as no."""
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def code_map(c: Column, names: Mapping[object, object], default: object) -> Column:
    """Value per code, the default for unknown and null codes."""
    out = None
    for code, name in names.items():
        out = F.when(c == F.lit(code), F.lit(name)) if out is None else out.when(c == F.lit(code), F.lit(name))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def remap(c: Column, changes: Mapping[object, object]) -> Column:
    """Replace some values; all others pass."""
    out = None
    for old, new in changes.items():
        out = F.when(c == F.lit(old), F.lit(new)) if out is None else out.when(c == F.lit(old), F.lit(new))
    return c if out is None else out.otherwise(c)


def phase_of(group: Column, marks: Sequence[tuple[Sequence[str], int]], default: int = 1) -> Column:
    """Phase of the first mark contained in the group name."""
    out = None
    for texts, phase in marks:
        hit = F.lit(False)
        for t in texts:
            hit = hit | group.contains(t)
        out = F.when(hit, F.lit(phase)) if out is None else out.when(hit, F.lit(phase))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def funded_state(phase: Column, funded_at: Column, in_funded_group: Column, is_active: Column) -> dict[str, Column]:
    """Phase, status and funded status of an account.

    Not funded yet: keeps its phase, status follows the active flag, funded status 0.
    Funded, group not in the funded set: pending (2, 0), or rejected (0, 2) when
    inactive. Funded, group in the set: approved (phase 0, status 1, funded status 1)
    when active; otherwise both states stay null.
    """
    waiting = funded_at.isNull()
    outside = ~in_funded_group
    approved = in_funded_group & (is_active == 1)
    rejected = outside & (is_active == 0)
    return {
        "current_phase": F.when(~waiting & approved, F.lit(0)).otherwise(phase).cast("int"),
        "status": F.when(waiting, is_active.cast("int"))
        .when(rejected, F.lit(0))
        .when(outside, F.lit(2))
        .when(approved, F.lit(1)),
        "funded_status": F.when(waiting, F.lit(0))
        .when(rejected, F.lit(2))
        .when(outside, F.lit(0))
        .when(approved, F.lit(1)),
    }


def target_group(
    action: Column,
    funded_at: Column,
    in_funded_group: Column,
    is_active: Column,
    competition: str,
    funded: str,
    evaluation: str,
) -> Column:
    """Group on the new platform: competition first, then approved accounts, then the rest."""
    approved = funded_at.isNotNull() & in_funded_group & (is_active == 1)
    return (
        F.when(F.lower(action.cast("string")) == "competition", F.lit(competition))
        .when(approved, F.lit(funded))
        .otherwise(F.lit(evaluation))
    )


def first_present(*columns: Column, blank: bool = False) -> Column:
    """First value that is not null (with ``blank``: nor empty text)."""
    return F.coalesce(*[blank_to_null(c) if blank else c for c in columns])


def flag_if(c: Column, value: object) -> Column:
    """1 where the column has the value, else 0."""
    return F.when(c == F.lit(value), F.lit(1)).otherwise(F.lit(0))


def difference(a: Column, b: Column) -> Column:
    return a - b


def number_text(c: Column) -> Column:
    """Number as text; null stays null."""
    return c.cast("string")


def run_time(as_of: str | None = None) -> Column:
    """Timestamp of the run: the given one, else the time of the query."""
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return F.lit(as_of).cast("timestamp_ntz")
