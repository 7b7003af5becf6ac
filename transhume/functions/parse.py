"""Parsing text into typed values, strictly or leniently.

Strict forms fail on text that does not parse in every session, not only where
``spark.sql.ansi.enabled`` is on. Timestamps carry no zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: shape of the source system's second-precision timestamps.
SECONDS_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"

# Escape sequences of MySQL string literals that stand for another
# character. Any other escaped character stands for itself.
MYSQL_ESCAPES = {
    "\\0": "\0",
    "\\b": "\b",
    "\\n": "\n",
    "\\r": "\r",
    "\\t": "\t",
    "\\Z": "\x1a",
}

# The escapes that most dumps hold no others of.
COMMON_ESCAPES = {"\\n": "\n", "\\'": "'", '\\"': '"'}


def _strict(source: Column, parsed: Column, what: str) -> Column:
    failure = F.raise_error(F.concat(F.lit(f"not a {what}: "), source.cast("string")))
    return F.when(source.isNull() | parsed.isNotNull(), parsed).otherwise(failure)


def as_date(c: Column) -> Column:
    return _strict(c, c.try_cast("date"), "date")


def as_timestamp(c: Column, shape: str | None = None) -> Column:
    """Strict parse; with ``shape``, text must also match that regular expression."""
    parsed = try_timestamp(c)
    if shape is not None:
        parsed = F.when(c.rlike(shape), parsed)
    return _strict(c, parsed, "timestamp")


def try_timestamp(c: Column) -> Column:
    """Lenient parse: text that is not a timestamp becomes null."""
    return c.try_cast("timestamp_ntz")


def _unescape(part: Column) -> Column:
    for written, meant in MYSQL_ESCAPES.items():
        part = F.replace(part, F.lit(written), F.lit(meant))
    return F.regexp_replace(part, r"(?s)\\(.)", "$1")


def sql_literal(v: Column) -> Column:
    """Value of one SQL literal: NULL, quoted text with escapes, or bare text."""
    v = F.btrim(v, F.lit(" \t\r\n"))
    # A character set may stand before a quoted text.
    v = F.when(v.startswith("_"), F.regexp_replace(v, r"""\A_[A-Za-z0-9]+\s*(?=['"])""", "")).otherwise(v)
    quote = F.substring(v, 1, 1)
    quoted = quote.isin("'", '"')
    body = F.substring(v, F.lit(2), F.length(v) - 2)
    body = F.replace(body, F.concat(quote, quote), quote)
    common = body
    for written, meant in COMMON_ESCAPES.items():
        common = F.replace(common, F.lit(written), F.lit(meant))
    # Escaped backslashes split the text, so what follows one is never misread.
    parts = F.transform(F.split(body, r"\\\\"), _unescape)
    decoded = (
        F.when(~body.contains("\\"), body)
        .when(~body.rlike(r"""\\[^n'"]"""), common)
        .otherwise(F.array_join(parts, "\\"))
    )
    is_null = F.upper(F.substring(v, 1, 5)) == "NULL"
    return F.when(is_null, F.lit(None)).when(quoted, decoded).otherwise(v)
