"""Projections that bring a table to its target columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transhume.functions.parse import as_date, as_timestamp
from transhume.functions.text import blank_to_null


def missing_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def select_available(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """Listed columns that exist, in list order; no list keeps all columns."""
    if columns is None:
        return df
    return df.select(*[_quoted(c) for c in columns if c in df.columns])


def select_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Listed columns in list order; a missing one is an error."""
    _require(df, columns)
    return df.select(*[_quoted(c) for c in columns])


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _require(df: DataFrame, columns: Sequence[str]) -> None:
    missing = missing_columns(df, columns)
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns that are there."""
    return df.withColumnsRenamed(names)


def copy_columns(df: DataFrame, copies: dict[str, str]) -> DataFrame:
    """New column → existing column; copies of absent columns are skipped."""
    return df.withColumns({new: _quoted(old) for new, old in copies.items() if old in df.columns})


def with_constants(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    return df.withColumns(values)


def with_defaults(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Add the columns that are absent."""
    return df.withColumns({c: v for c, v in values.items() if c not in df.columns})


def redact(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Set secret columns to null."""
    return df.withColumns({c: F.lit(None).cast("string") for c in columns if c in df.columns})


def blanks_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: blank_to_null(_quoted(c)) for c in columns if c in df.columns})


def fill_cast(df: DataFrame, sources: dict[str, str], default: int = 0, type_: str = "int") -> DataFrame:
    """New column → source column with nulls replaced; the default where the source is absent."""
    filled = {
        new: F.coalesce(_quoted(old), F.lit(default)).cast(type_) if old in df.columns else F.lit(default).cast(type_)
        for new, old in sources.items()
        if new not in df.columns
    }
    return df.withColumns(filled)


def drop_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns that must all exist."""
    _require(df, columns)
    return df.drop(*columns)


def drop_if_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def move_before(df: DataFrame, column: str, anchor: str) -> DataFrame:
    """Place a column just before another; unchanged when either is absent."""
    if missing_columns(df, [column, anchor]):
        return df
    order = [c for c in df.columns if c != column]
    order.insert(order.index(anchor), column)
    return df.select(*[_quoted(c) for c in order])


def cast_columns(df: DataFrame, types: dict[str, str], lenient: bool = False) -> DataFrame:
    """Cast the columns that are there; text becomes dates and timestamps by strict parsing."""
    strings = {n for n, t in df.dtypes if t == "string"}

    def converted(name: str, target: str) -> Column:
        c = _quoted(name)
        if lenient:
            return c.try_cast(target)
        if name in strings and target == "date":
            return as_date(c)
        if name in strings and target == "timestamp_ntz":
            return as_timestamp(c)
        return c.cast(target)

    return df.withColumns({n: converted(n, t) for n, t in types.items() if n in df.columns})


def parse_seconds(df: DataFrame, columns: Sequence[str], shape: str) -> DataFrame:
    """Strictly parse text timestamps of one shape; columns that are already typed stay."""
    strings = {n for n, t in df.dtypes if t == "string"}
    return df.withColumns({c: as_timestamp(_quoted(c), shape) for c in columns if c in strings})
