"""Small text expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def present(*columns: Column) -> Column:
    """True when any of the columns holds non-blank text."""
    return F.coalesce(*[blank_to_null(c) for c in columns]).isNotNull()


def text_of(c: Column) -> Column:
    """Text form of a value; null stays null."""
    return c.cast("string")


def has_any_prefix(c: Column, prefixes: Iterable[str]) -> Column:
    return reduce(or_, [c.startswith(F.lit(p)) for p in prefixes])
