"""Keeping one row per key.

``row_number() = 1`` over a key is planned with a limit per key before the shuffle:
each map task hands on one row per key at most. A key that holds a third of the
table therefore sends as many rows as there are map tasks, not a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transhume.functions.keys import wide_key

COLLAPSE, KEEP, DROP = "collapse", "keep", "drop"
_RANK = "__rank"


def _order(order_by: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_by]


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    null_keys: str = COLLAPSE,
    wide: Sequence[str] = (),
) -> DataFrame:
    """First row per key in the given order.

    The order should end in a unique column; rows that tie on all of it are chosen
    from freely. Null counts as one key (COLLAPSE), or rows with a null key part all
    stay (KEEP) or all go (DROP). Keys named in ``wide`` are long texts: their digests are
    shuffled and sorted in their place.
    """
    if null_keys not in (COLLAPSE, KEEP, DROP):
        raise ValueError(f"unknown null_keys: {null_keys}")
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    rows = df if null_keys == COLLAPSE else df.filter(whole)
    window = Window.partitionBy(*[wide_key(k) if k in wide else F.col(k) for k in keys]).orderBy(*_order(order_by))
    kept = rows.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)
    return kept.unionByName(df.filter(~whole)) if null_keys == KEEP else kept


def keep_preferred(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    preferred: Column,
    null_keys: str = COLLAPSE,
) -> DataFrame:
    """First preferred row per key, else the first row."""
    rank = F.when(preferred, 0).otherwise(1).asc()
    return keep_first(df, keys, [rank, *order_by], null_keys)


def flag_preferred(
    df: DataFrame,
    preferences: DataFrame,
    key: str,
    choice: str,
    flag: str,
    last_by: Sequence[str] | None = None,
) -> DataFrame:
    """Add a flag: the preference table names this row's ``choice`` for its ``key``.

    A key with several preferences follows the last one in ``last_by`` order (else the
    greatest choice). The join is on key and choice together, so that a frequent key
    spreads over its choices instead of meeting in one task.
    """
    order = F.struct(*[F.col(c) for c in (last_by or [choice])])
    one = (
        preferences.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("__k"))
        .agg(F.max_by(F.col(choice).cast("string"), order).alias("__c"))
        .withColumn(flag, F.lit(True))
    )
    on = (df[key] == one["__k"]) & (df[choice].cast("string") == one["__c"])
    return df.join(one, on, "left").drop("__k", "__c").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of some columns."""
    return df.select(*columns).distinct()


def sorted_distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return distinct_rows(df, columns).orderBy(*columns)


def with_input_order(df: DataFrame, names: tuple[str, str, str] = ("__file", "__block", "__row")) -> DataFrame:
    """Add the position in the source files, to order by where a table has no key.

    Apply it straight to a scan: file, start of the split, row within the task.
    """
    return df.withColumns(
        {
            names[0]: F.col("_metadata.file_path"),
            names[1]: F.col("_metadata.file_block_start"),
            names[2]: F.monotonically_increasing_id(),
        }
    )
