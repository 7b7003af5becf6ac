"""Row filters. Null tests false, as in SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transhume.functions.text import has_any_prefix, present, text_of


def exclude_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Drop rows whose text starts with the prefix, and rows without text."""
    return df.filter(~F.col(column).startswith(F.lit(prefix)))


def equals_and_prefix(df: DataFrame, column: str, value: str, text: str, prefixes: Sequence[str]) -> DataFrame:
    """Rows of one kind whose text starts with any of the prefixes."""
    return df.filter((F.col(column) == value) & has_any_prefix(F.col(text), prefixes))


def keep_members(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(column).isin(list(values)))


def drop_members(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose value is not in the list; null values go, unless the list is empty."""
    if not values:
        return df
    return df.filter(~F.col(column).isin(list(values)))


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
    return df


def any_present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with non-blank text in at least one of the columns."""
    return df.filter(present(*[F.col(c) for c in columns]))


def since_days(df: DataFrame, column: str, as_of: dt.datetime, days: int = 180) -> DataFrame:
    """Rows not older than a number of days before ``as_of``; rows without a time go."""
    return df.filter(F.col(column) >= _moment(as_of - dt.timedelta(days=days)))


def since_date(df: DataFrame, cutoff: dt.date, column: str | None = None) -> DataFrame:
    """Rows at or after a date; without a column the first date-like column counts."""
    name = column or first_time_column(df)
    if name is None:
        raise ValueError("the table has no date or timestamp column")
    return df.filter(F.col(name) >= _moment(dt.datetime(cutoff.year, cutoff.month, cutoff.day)))


def first_time_column(df: DataFrame) -> str | None:
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return next((f.name for f in df.schema.fields if isinstance(f.dataType, kinds)), None)


def _moment(at: dt.datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def slice_by_key(df: DataFrame, column: str, key: object) -> DataFrame:
    """Rows of one key, compared as text.

    Where the column is already text or a whole number the comparison is made in the
    column's own type, so that it reaches the scan. A key may also be a scalar subquery.
    """
    if isinstance(key, Column):
        return df.filter(F.col(column) == key)
    kind = df.schema[column].dataType
    wanted = str(key)
    if isinstance(kind, T.StringType):
        return df.filter(F.col(column) == wanted)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        if wanted.lstrip("-").isdigit() and str(int(wanted)) == wanted:
            return df.filter(F.col(column) == F.lit(int(wanted)))
        return df.filter(F.lit(False))
    return df.filter(text_of(F.col(column)) == wanted)
