"""Gapless numbers within keys, without bringing a key to one task."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from transhume.session import stage

#: Columns that hold a row's task and its place among the rows of its key in that task.
TASK, PLACE = "_task", "_place"


def numbered(
    df: DataFrame,
    keys: list[str],
    result: str,
    name: str,
    make: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None,
    made: T.StructType | None = None,
) -> DataFrame:
    """Add ``result``: 0, 1, 2 … within each combination of ``keys`` (a null is a key like any other).

    Rows are numbered within their task and written once, so that a repeated task cannot
    number them anew; the start of each task within a key is a running sum over one
    count per task and key. Tasks count in the order of their partitions: after
    ``repartitionByRange`` and a sort within partitions the numbers follow the sort.

    ``make`` and ``made`` are a step for ``mapInArrow`` and its schema that is taken before, in
    the same Python worker: two such steps after each other would be two workers a task.
    """
    kinds = made or df.schema
    schema = to_arrow_schema(kinds).append(pa.field(TASK, pa.int32())).append(pa.field(PLACE, pa.int64()))
    placed = stage(df.mapInArrow(partial(_place, keys, schema, make), from_arrow_schema(schema)), name)
    counts = placed.groupBy(*keys, TASK).agg(F.count("*").alias("_rows"))
    before = Window.orderBy(TASK).rowsBetween(Window.unboundedPreceding, -1)
    before = before.partitionBy(*keys) if keys else before.partitionBy(F.lit(0))
    starts = counts.select(*keys, TASK, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    other = starts.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.col(TASK).alias("_at"), "_start")
    on = F.col(TASK) == F.col("_at")
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return placed.join(other, on).select(
        *[c for c in kinds.names if c != result], (F.col("_start") + F.col(PLACE)).alias(result)
    )


def _place(keys: list[str], schema: pa.Schema, make, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, seen = TaskContext.get().partitionId(), {}
    for b in make(batches) if make else batches:
        places = []
        columns = [b.column(k).to_pylist() for k in keys]
        for key in zip(*columns, strict=True) if keys else [()] * b.num_rows:
            n = seen.get(key, 0)
            seen[key] = n + 1
            places.append(n)
        arrays = [*b.columns, pa.array([task] * b.num_rows, pa.int32()), pa.array(places, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)
