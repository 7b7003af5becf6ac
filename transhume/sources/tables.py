"""CSV and parquet tables with fixed schemas."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Column that says where in its source a row stands: file, place of the split in it, place in that. It
#: orders the rows as the files hold them, files by name, and stays with a row that is stored.
POSITION = "_position"

# Quotes are doubled, as PostgreSQL and most tools write them. The marker for null
# keeps an empty quoted cell ("") apart from an empty one.
_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

_CSV_WRITE = {
    **_CSV,
    "nullValue": "",
    "emptyValue": '""',
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

TOLERANT = "PERMISSIVE"
STRICT = "FAILFAST"


def _is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def csv_columns(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names in the header of the first file."""
    return spark.read.options(**_CSV).csv(path).columns


def files_by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """The files of a folder, those of an equal header together.

    One pass over the lines, of which each task keeps the first of its files; the names of the files, which a
    scan needs on the driver as well, are all that is brought there.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at")
    )
    first = lines.groupBy("file").agg(F.min_by(F.rtrim("value", F.lit("\r")), "at").alias("header"))
    groups = first.groupBy("header").agg(F.array_sort(F.collect_list("file")).alias("files"))
    return sorted(r.files for r in groups.collect())


def read_csv_folder(spark: SparkSession, path: str, schema: T.StructType | str | None = None, **csv) -> DataFrame:
    """A CSV table whose files differ in their headers: one scan a header, put together by column name.

    A column that a file lacks is null in its rows. Options are those of ``read_csv``. Costs a pass
    over the lines before the scan.
    """
    whole: DataFrame | None = None
    for files in files_by_header(spark, path):
        part = read_csv(spark, files, schema, **csv)
        whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    return read_csv(spark, path, schema, **csv) if whole is None else whole


def with_position(df: DataFrame, name: str = POSITION) -> DataFrame:
    """Add the position of each row; apply it straight to a scan of files."""
    return df.withColumn(
        name,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    overrides: dict[str, str] | None = None,
    mode: str = STRICT,
    corrupt_column: str | None = None,
    multiline: bool = False,
    position: bool = False,
    checked: bool = False,
) -> DataFrame:
    """Scan a CSV table.

    Types are matched to the file by column name, so a file may order its columns
    freely, lack some of them or hold others (read as text). ``overrides`` replaces
    single types. ``mode`` STRICT fails on a cell of the wrong type, TOLERANT makes
    the cell null and keeps the row; ``corrupt_column`` then holds the raw line of
    such rows. ``multiline`` reads line breaks inside quotes, at the price that a
    file is no longer split between tasks. ``position`` adds the column ``POSITION``. A scan parses
    the columns that are asked for; ``checked`` makes it parse all, so that in STRICT mode a cell of the wrong type raises
    wherever it stands, also for a count. Without a schema the types are inferred,
    which costs another pass over the data.
    """
    reader = spark.read.options(**_CSV).options(mode=mode, multiLine=multiline, enforceSchema=False)
    if schema is None:
        inferred = spark.read.options(**_CSV).option("inferSchema", "true").csv(path).schema
        schema = inferred
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    types = {f.name: f.dataType for f in schema.fields}
    for name, ddl in (overrides or {}).items():
        types[name] = T.StructType.fromDDL(f"c {ddl}").fields[0].dataType
    fields = [T.StructField(c, types.get(c, T.StringType())) for c in csv_columns(spark, path)]
    if corrupt_column is not None:
        fields.append(T.StructField(corrupt_column, T.StringType()))
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    rows = reader.schema(T.StructType(fields)).csv(path)
    rows = with_position(rows) if position else rows
    if checked:
        # Always true, but not to be told without every cell, nor after a filter that leaves rows out.
        cells = F.xxhash64(*[_column(f.name) for f in fields]).bitwiseOR(F.lit(1)) != 0
        rows = rows.filter(cells & (F.monotonically_increasing_id() >= 0))
    return rows


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def bad_cells(rows: DataFrame, corrupt_column: str) -> dict[str, Column]:
    """For each column of a TOLERANT scan whether a row's cell was there and of the wrong type.

    Only the raw lines that the scan kept in ``corrupt_column`` are read once more, as text.
    """
    names = [f.name for f in rows.schema if f.name not in (corrupt_column, POSITION)]
    texts = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    options = {k: v for k, v in _CSV.items() if k != "header"}
    cells = F.from_csv(_column(corrupt_column), texts.simpleString()[7:-1].replace(":", " ").replace(",", ", "), options)
    raw = _column(corrupt_column)
    return {n: raw.isNotNull() & cells[f"c{i}"].isNotNull() & (cells[f"c{i}"] != "") & _column(n).isNull() for i, n in enumerate(names)}


def tolerated_cells(rows: DataFrame, corrupt_column: str) -> DataFrame:
    """Cells of the wrong type that a TOLERANT scan made null: ``column`` and ``cells``, in one pass."""
    found = bad_cells(rows, corrupt_column)
    counts = rows.agg(*[F.count(F.when(bad, F.lit(1))).alias(f"n{i}") for i, bad in enumerate(found.values())])
    pairs = [F.struct(F.lit(n).alias("column"), F.col(f"n{i}").alias("cells")) for i, n in enumerate(found)]
    return counts.select(F.inline(F.array(*pairs)))


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, position: bool = False, **csv
) -> DataFrame:
    """Scan a table: parquet when the path says so, else CSV."""
    if path.rstrip("/").endswith(".parquet"):
        rows = spark.read.parquet(path)
        return with_position(rows) if position else rows
    return read_csv(spark, path, schema, position=position, **csv)


def read_optional(spark: SparkSession, path: str, schema: T.StructType | str | None = None, **csv) -> DataFrame | None:
    """Like ``read_table``, but None when the path does not exist."""
    try:
        return read_table(spark, path, schema, **csv)
    except AnalysisException as error:
        if _is_missing(error):
            return None
        raise


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Replace the files at a path by what ``write`` puts into a fresh folder beside it.

    The earlier files stay where they are until the new ones are complete; a write that fails leaves them
    as they were and nothing else. Then the two folders change places by renaming. On a file
    system that renames in one step a reader finds either the old files or the new ones, but for
    the moment between the two steps; if the second one fails, the old files are put back.
    """
    jvm = spark._jvm
    fs_path = jvm.org.apache.hadoop.fs.Path
    target = fs_path(path.rstrip("/"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    mark = uuid.uuid4().hex[:12]
    attempt, earlier = (fs_path(target.getParent(), f"_{kind}_{target.getName()}_{mark}") for kind in ("attempt", "earlier"))
    try:
        write(attempt.toString())
        had = fs.exists(target)
        if had and not fs.rename(target, earlier):
            raise OSError(f"{path} cannot be renamed")
        if not fs.rename(attempt, target):
            if had:
                fs.rename(earlier, target)
            raise OSError(f"{path} cannot be replaced")
        if had:
            fs.delete(earlier, True)
    finally:
        fs.delete(attempt, True)


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Write one table as a folder of CSV files with headers; earlier files are replaced at the end (see ``publish``)."""
    write = lambda to: df.write.options(**_CSV_WRITE).csv(to, compression=compression)
    publish(df.sparkSession, path, write)


def write_parquet(df: DataFrame, path: str) -> None:
    """Write one table as a folder of parquet files; earlier files are replaced at the end (see ``publish``)."""
    publish(df.sparkSession, path, lambda to: df.write.parquet(to))


def csv_sink(folder: str, compression: str | None = None) -> Callable[[DataFrame, str], DataFrame]:
    """A ``write`` for ``run_all``: a folder of CSV files per table; gives back the table as it was written."""

    def write(df: DataFrame, name: str) -> DataFrame:
        path = f"{folder.rstrip('/')}/{name}"
        write_csv(df, path, compression)
        return read_csv(df.sparkSession, path, df.schema, multiline=True)

    return write


def parquet_sink(folder: str) -> Callable[[DataFrame, str], DataFrame]:
    """The same with parquet files."""

    def write(df: DataFrame, name: str) -> DataFrame:
        path = f"{folder.rstrip('/')}/{name}"
        write_parquet(df, path)
        return df.sparkSession.read.parquet(path)

    return write


def row_count(df: DataFrame) -> int:
    return df.count()


def read_column_list(spark: SparkSession, path: str, default: list[str] | None = None) -> list[str] | None:
    """Ordered column list from a JSON array, or an object with a ``columns`` array.

    A missing file gives ``default`` (None: keep all columns); a file that is not
    such a list is an error.
    """
    try:
        text = spark.read.text(path, wholetext=True).first()
    except AnalysisException as error:
        if _is_missing(error):
            return default
        raise
    value = json.loads(text.value if text else "")
    if isinstance(value, dict):
        value = value.get("columns")
    if not isinstance(value, list) or not all(isinstance(c, str) for c in value):
        raise ValueError(f"{path}: expected a JSON array of column names")
    return value
