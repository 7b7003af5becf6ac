"""Counts and rates that document a migration. All are one-pass aggregates."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from transhume.functions.keys import wide_key


def count_if(condition: Column) -> Column:
    """Number of rows that meet a condition; null does not."""
    return F.count(F.when(condition, F.lit(1)))


def frequency(df: DataFrame, column: str, count_name: str = "count") -> DataFrame:
    """Rows per value, most frequent first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias(count_name))
    return counts.orderBy(F.desc(count_name), F.asc_nulls_first(column))


def distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and percentage per value of each column, as (measure, value, count, percentage).

    The table is read once: every row is counted under each of its measures, and the
    counts are combined before they are shuffled.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("measure"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    counts = df.select(F.inline(pairs)).groupBy("measure", "value").agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy("measure").agg(F.sum("count").alias("total"))
    return counts.join(totals, "measure").select(
        "measure", "value", "count", percentage(F.col("count"), F.col("total"), 2).alias("percentage")
    )


def duplicate_counts(df: DataFrame, keys: Sequence[str], wide: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct keys and surplus rows; null counts as a key. Keys named in ``wide`` are counted by digest."""
    per_key = df.groupBy(*[wide_key(k) if k in wide else F.col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicates"),
    )


def match_counts(df: DataFrame, *columns: str) -> DataFrame:
    """For each looked-up column the rows with and without a value, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(c).alias(f"{c}_matched") for c in columns],
        *[count_if(F.col(c).isNull()).alias(f"{c}_unmatched") for c in columns],
    )


def percentage(part: Column, whole: Column, digits: int) -> Column:
    """Rounded percentage; 0 where there is nothing to divide by."""
    return F.when(whole > 0, F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)).otherwise(F.lit(0.0))


def match_rate(df: DataFrame, column: str, digits: int = 1) -> DataFrame:
    """Rows, matched rows and match rate of a looked-up column."""
    counted = df.agg(F.count(F.lit(1)).alias("total"), F.count(column).alias("matched"))
    return counted.withColumn("match_rate", percentage(F.col("matched"), F.col("total"), digits))


def retention(original: DataFrame, final: DataFrame) -> DataFrame:
    """Original and final row counts, rows removed and retention rate."""
    before = original.agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = final.agg(F.count(F.lit(1)).alias("final_records")).withColumn("original_records", before)
    return counted.select(
        "original_records",
        "final_records",
        (F.col("original_records") - F.col("final_records")).alias("total_removed"),
        percentage(F.col("final_records"), F.col("original_records"), 2).alias("retention_rate"),
    )


def precedence_counts(df: DataFrame, primary: str, backup: str) -> DataFrame:
    """Rows served by the primary source, by the backup, and by none."""
    p, b = F.col(primary), F.col(backup)
    return df.agg(
        F.count(p).alias("from_primary"),
        count_if(p.isNull() & b.isNotNull()).alias("from_backup"),
        count_if(p.isNull() & b.isNull()).alias("from_none"),
    )


def flag_counts(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Rows per named condition, with the number of all rows."""
    return df.agg(F.count(F.lit(1)).alias("total"), *[count_if(c).alias(n) for n, c in flags.items()])


def unmatched_samples(df: DataFrame, key: str, looked_up: str, n: int = 10) -> DataFrame:
    """The first few distinct keys that found no match."""
    return df.filter(F.col(looked_up).isNull()).select(key).distinct().orderBy(F.asc_nulls_first(key)).limit(n)


STEP_COLUMNS = ("step_no", "step_name", "records_before", "records_after", "records_removed", "reason", "details")


def funnel_rows(
    counts: DataFrame, steps: Sequence[tuple[str, str, str, str]], details: dict[str, dict[str, Column]] | None = None
) -> DataFrame:
    """Step rows from one row of counts.

    A step is (name, reason, column with the count before, column with the count
    after); its details are text values by name.
    """
    details = details or {}
    rows = []
    for i, (name, reason, before, after) in enumerate(steps, 1):
        pairs = [x for k, v in details.get(name, {}).items() for x in (F.lit(k), v.cast("string"))]
        extra = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
        rows.append(
            F.struct(
                F.lit(i).alias("step_no"),
                F.lit(name).alias("step_name"),
                F.col(before).alias("records_before"),
                F.col(after).alias("records_after"),
                (F.col(before) - F.col(after)).alias("records_removed"),
                F.lit(reason).alias("reason"),
                extra.alias("details"),
            )
        )
    return counts.select(F.inline(F.array(*rows)))


def step_funnel(df: DataFrame, steps: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Funnel of row conditions that apply one after another.

    A step is (name, reason, condition to stay). All steps are counted in one pass,
    each with the conditions before it.
    """
    passed = F.lit(True)
    counts = [F.count(F.lit(1)).alias("n0")]
    rows = []
    for i, (name, reason, condition) in enumerate(steps, 1):
        passed = passed & condition
        counts.append(count_if(passed).alias(f"n{i}"))
        rows.append((name, reason, f"n{i - 1}", f"n{i}"))
    return funnel_rows(df.agg(*counts), rows)


#: Sees the rows after a step, under the step's name, and gives them on.
Watch = Callable[[DataFrame, str], DataFrame]


def unwatched(df: DataFrame, step: str) -> DataFrame:
    return df


class Counts:
    """Row counts of steps, made by the job that runs them: no row is read again to be counted.

    ``watch`` puts a step under observation. ``taken`` are the counts once the plan has run; it waits for them,
    so it is asked only after the plan's first action. Of a plan that runs twice the first run counts.
    """

    def __init__(self) -> None:
        self._seen: list[tuple[str, Observation]] = []

    def watch(self, df: DataFrame, step: str, matched: Sequence[str] = ()) -> DataFrame:
        """Count the rows of a step, and those that have a value in each of some columns."""
        seen = Observation()
        self._seen.append((step, seen))
        rows = F.count(F.lit(1)).alias("rows")
        return df.observe(seen, rows, *[count_if(F.col(c).isNotNull()).alias(f"matched_{i}") for i, c in enumerate(matched)])

    def taken(self, matched: Sequence[str] = ()) -> dict[str, int]:
        """Rows of every step, and ``<column>_matched`` of the step that was asked for them."""
        out: dict[str, int] = {}
        for step, seen in self._seen:
            found = seen.get
            out[step] = found["rows"]
            out.update({f"{c}_matched": found[f"matched_{i}"] for i, c in enumerate(matched) if f"matched_{i}" in found})
        return out
