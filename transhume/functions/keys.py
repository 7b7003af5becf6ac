"""Surrogate keys and codes.

A key is by default a pure function of the entity name and the source key. It can
be recomputed anywhere, a retried task writes the same value again, and no table
has to be lined up with another by row position.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits of the digest that a code is made of: 60 bits.
_CODE_HEX = 15


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _digest(entity: str, keys: tuple[str | Column, ...]) -> Column:
    # The length before each part keeps different keys apart, whatever the parts hold.
    texts = [_col(k).cast("string") for k in keys]
    parts = [F.coalesce(F.concat(F.char_length(t), F.lit(":"), t), F.lit("N")) for t in texts]
    return F.md5(F.concat_ws("|", F.lit(entity), *parts))


def uuid_from(entity: str, *keys: str | Column) -> Column:
    """UUID text derived from the entity name and its source key."""
    h = _digest(entity, keys)
    bounds = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(h, start, size) for start, size in bounds])


def random_uuid() -> Column:
    """Version-4 UUID per row, for rows that have no key and that nothing refers to."""
    return F.uuid()


def _code(hexed: Column, size: int) -> Column:
    if size > 11:
        raise ValueError("a code has 11 characters at most")
    return F.right(F.lpad(F.conv(F.substring(hexed, 1, _CODE_HEX), 16, 36), 12, "0"), F.lit(size))


def code_from(entity: str, *keys: str | Column, size: int = 8) -> Column:
    """Code of digits and upper-case letters derived from the source key.

    Of n keys about n² / (2 · 36^size) codes repeat: with 8 characters 0.2 among a million.
    """
    return _code(_digest(entity, keys), size)


def random_code(size: int = 8) -> Column:
    """Code of digits and upper-case letters per row."""
    return _code(F.md5(F.uuid()), size)


def wide_key(column: str | Column) -> Column:
    """128-bit digest that stands for a wide text in shuffles and sorts; null stays null."""
    return F.unhex(F.md5(_col(column)))
