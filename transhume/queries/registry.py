"""Registration of queries and of the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL where there is one."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def once(build: Query) -> Query:
    """Build a table once per application and folder; later queries share it."""
    held: dict[tuple[str, ...], DataFrame] = {}

    @wraps(build)
    def shared(spark: SparkSession, sf_dir: str, *name: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, *name)
        if key not in held:
            held[key] = build(spark, sf_dir, *name)
        return held[key]

    return shared


@once
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _digest_sql(entity: str, keys: tuple[str, ...]) -> str:
    texts = [f"CAST({k} AS VARCHAR)" for k in keys]
    return f"md5('{entity}'" + "".join(f" || '|' || coalesce(length({t}) || ':' || {t}, 'N')" for t in texts) + ")"


def uuid_sql(entity: str, *keys: str) -> str:
    """SQL of the uuid that is derived from an entity name and a key."""
    h = _digest_sql(entity, keys)
    bounds = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return " || '-' || ".join(f"substr({h}, {start}, {size})" for start, size in bounds)


def code_sql(entity: str, *keys: str, size: int = 8) -> str:
    """SQL of the code: the last digits of 60 bits of the digest to the base 36."""
    number = f"CAST('0x' || substr({_digest_sql(entity, keys)}, 1, 15) AS BIGINT)"
    digits = [f"substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST({number} // {36**i} % 36 AS INTEGER) + 1, 1)" for i in reversed(range(size))]
    return "(" + " || ".join(digits) + ")"
