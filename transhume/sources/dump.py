"""MySQL dumps as DataFrames.

A statement is the unit of parallelism: files are cut into statements in many tasks, and
each INSERT is taken apart by regular expressions on the executors. mysqldump starts a new
INSERT whenever its buffer is full, so a large table arrives as many statements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transhume.functions.parse import sql_literal
from transhume.session import stage_path
from transhume.sources import lexer
from transhume.sources.tables import POSITION
from transhume.sources.lexer import BLOCK, DOUBLE, LINE, NAME, SINGLE

# The text forms of a dump.
STATEMENT_END = ";\n"


def _nested(depth: int) -> str:
    """Text in parentheses, with literals and further parentheses inside."""
    inner = rf"|{_nested(depth - 1)}" if depth else ""
    return rf"\((?:[^()'\"\\]++|{SINGLE}|{DOUBLE}{inner})*+\)"


_CALL = _nested(3)
_TUPLE = rf"(?s)\(((?:[^()'\"\\]++|{SINGLE}|{DOUBLE}|{_CALL})*+)\)"
_VALUE = rf"(?s)(?:^|,)((?:[^,()'\"]++|{SINGLE}|{DOUBLE}|{_CALL})*+)"
_QUOTED = r"`(?:[^`]|``)++`"
_NAME = rf"(?:(?:{_QUOTED}|[^`\s.(]++)\s*\.\s*)?({_QUOTED}|[^`\s(]+)"
_INSERT_HEAD = (
    r"(?is)\A(?:INSERT|REPLACE)\s+(?:(?:LOW_PRIORITY|DELAYED|HIGH_PRIORITY|IGNORE)\s+)*(?:INTO\s+)?"
    + _NAME
    + rf"\s*(\((?:[^()`]++|{_QUOTED})*+\))?\s*VALUES?\s*(?=\()"
)
_CREATE_HEAD = r"(?is)\ACREATE\s+(?:TEMPORARY\s+)?TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?" + _NAME + r"\s*\("
# What a definition is made of: the items between its commas, and the first word of each.
_BODY = rf"(?:[^()'\"`]++|{SINGLE}|{DOUBLE}|{_QUOTED}|{_nested(4)})*+"
_ITEM = rf"(?s)(?:\A|,)((?:[^,()'\"`]++|{SINGLE}|{DOUBLE}|{_QUOTED}|{_nested(4)})++)"
_FIRST_WORD = rf"(?s)\A\s*+({_QUOTED}|\"(?:[^\"]|\"\")++\"|[^\s(`\"]++)"
# Words that begin an item of a definition that is no column.
_NO_COLUMN = "PRIMARY KEY INDEX UNIQUE FULLTEXT SPATIAL CONSTRAINT FOREIGN CHECK PERIOD LIKE EXCLUDE".split()
_COMMENT = rf"{LINE}|{BLOCK}"
# An executable comment that holds a definition or rows is a statement.
_HELD = r"/\*!\d*+\s*(?:INSERT|REPLACE|CREATE\s+(?:TEMPORARY\s+)?TABLE)\b"
_COMMENTS = rf"(?is)\A(?:\s++|;|{LINE}|(?!{_HELD}){BLOCK})*+"
_EXECUTABLE = rf"(?is)\A(?={_HELD})/\*!\d*+\s*+(.*?)\s*\*/"
# A statement ends at a semicolon, outside of literals, after which only blanks stand in its line.
_STATEMENT = (
    rf"(?s)\G((?:[^;'\"`\-#/]++|{SINGLE}|{DOUBLE}|{NAME}|{_COMMENT}|;(?![ \t\r]*+(?:\n|\z))|[\-#/'\"`])++)(?:;[ \t\r]*+\n?|\z)"
)
# What remains of an INSERT once its tuples are taken out.
_BETWEEN = r"(?is)^[\s,;]*(?:ON\s+DUPLICATE\s+KEY\s+UPDATE\b.*)?$"
# How statements begin that hold no rows.
_OTHERS = (
    "ALTER ANALYZE BEGIN CALL CHANGE COMMIT CREATE DELETE DELIMITER DROP END FLUSH GRANT LOCK OPTIMIZE SELECT SET START "
    "TRUNCATE UNLOCK UPDATE USE"
).split()
# A routine's statements are not the dump's, and another delimiter's statements are not cut here.
_ROUTINE = (
    r"(?is)\A(?:CREATE\b(?:(?!\bBEGIN\b)[^'\"`]|`[^`]*+`)*?\b(?:PROCEDURE|FUNCTION|TRIGGER|EVENT)\b.*\bBEGIN\b|DELIMITER\s+[^\s;]+\s+\S)"
)


class RejectedStatements(ValueError):
    """A dump holds statements that are not wholly understood, or rows that do not fit their table."""


def read_statements(
    spark: SparkSession, path: str, name_contains: str | None = None, statement_end: str | None = None
) -> DataFrame:
    """One row per statement of one dump file, or of all ``*.sql`` files in a folder: ``statement file block order``.

    Files are read once and stored, cut at every semicolon outside of literals, names and
    comments, in many tasks whatever the line ends. Where ``statement_end`` is given, the files
    are split at that text instead and nothing is stored; it must not occur within a statement.
    """
    if statement_end is None:
        return as_statements(lexer.statements(lexer.read_pieces(spark, path, name_contains)))
    reader = spark.read.option("lineSep", statement_end)
    if name_contains is not None:
        reader = reader.option("pathGlobFilter", f"*{name_contains}*.sql")
    elif not path.endswith(".sql"):
        reader = reader.option("pathGlobFilter", "*.sql")
    return statements_of(reader.text(path).select("value", F.col("_metadata.file_path").alias("file")))


def as_statements(found: DataFrame) -> DataFrame:
    """Statements without the comments before them, from whole ones with their place."""
    return _once(found.withColumnRenamed("text", "statement"), F.array(_without_comments(F.col("statement"))))


def statements_of(records: DataFrame) -> DataFrame:
    """Statements without the comments before them, from records of ``value`` and ``file``."""
    text = F.col("statement")
    cut = F.when(text.rlike(r";[ \t\r]*+\n"), F.regexp_extract_all(text, F.lit(_STATEMENT), F.lit(1))).otherwise(F.array(text))
    return _once(records.select(F.col("value").alias("statement"), "file"), F.transform(cut, _without_comments))


def _once(statements: DataFrame, code: Column) -> DataFrame:
    """Statements that are not empty; exploded, as a plain projection would be worked out by every filter after it."""
    others = [c for c in statements.columns if c != "statement"]
    return statements.select(F.explode(code).alias("statement"), *others).filter(F.col("statement") != "")


def _commented(text: Column) -> Column:
    """Whether a statement may begin with a comment or a blank; a pattern would look for its start at every place."""
    return F.left(text, F.lit(1)).isin(" ", "\t", "\n", "\r", "\x0b", "\f", ";", "-", "#", "/")


def _without_comments(text: Column) -> Column:
    """A statement from its first word to its last; one in an executable comment is taken out of it."""
    bare = F.regexp_replace(F.regexp_replace(text, _COMMENTS, ""), _EXECUTABLE, "$1")
    bare = F.when(_commented(text), bare).otherwise(text)
    ends = F.lit(False)
    for c in (*"; \t\r\n\x0b\f", "*/"):
        ends |= F.endswith(text, F.lit(c))
    return F.when(ends, F.rtrim(bare, F.lit("; \t\r\n\x0b\f"))).otherwise(bare)


def _code(statements: DataFrame) -> DataFrame:
    """The statements as code, whether or not comments were taken off before."""
    text = F.col("statement")
    return _once(statements, F.array(F.when(_commented(text), _without_comments(text)).otherwise(text)))


def _unquoted(name: Column) -> Column:
    """A name as it is meant: without its quotes, doubled ones inside single."""
    inner = F.substring(name, F.lit(2), F.length(name) - 2)
    return (
        F.when(name.startswith("`"), F.replace(inner, F.lit("``"), F.lit("`")))
        .when(name.startswith('"'), F.replace(inner, F.lit('""'), F.lit('"')))
        .otherwise(name)
    )


def table_columns(statements: DataFrame) -> DataFrame:
    """Table and its ordered column names, from the CREATE TABLE statements.

    A definition is split at its commas, outside of literals, names and parentheses, so it may
    stand on one line or many, with quoted names or bare ones. Keys, constraints and checks are
    left out. Of several definitions of one table, the one in the first file counts. Comments before a
    statement do not matter.
    """
    code = _code(statements.filter(F.col("statement").rlike(r"(?i)CREATE"))).filter(F.col("statement").rlike(_CREATE_HEAD))
    bare = F.regexp_replace("statement", rf"(?s)({SINGLE}|{DOUBLE}|{_QUOTED})|{_COMMENT}", "$1")
    body = F.regexp_extract(bare, _CREATE_HEAD + rf"({_BODY})\)", 2)
    words = F.transform(
        F.regexp_extract_all(body, F.lit(_ITEM), F.lit(1)), lambda item: F.regexp_extract(item, _FIRST_WORD, 1)
    )
    columns = F.filter(words, lambda w: (w != "") & ~F.upper(w).isin(_NO_COLUMN))
    found = code.select(
        _unquoted(F.regexp_extract("statement", _CREATE_HEAD, 1)).alias("table"), F.transform(columns, _unquoted).alias("columns"), "file"
    )
    return found.filter(F.size("columns") > 0).groupBy("table").agg(F.min_by("columns", "file").alias("columns"))


def inserts(statements: DataFrame) -> DataFrame:
    """INSERT and REPLACE statements: table, file, text of the value list, column list (null without one)."""
    listed = F.regexp_extract_all(F.regexp_extract("statement", _INSERT_HEAD, 2), F.lit(rf"{_QUOTED}|[^`\s(),]+"), F.lit(0))
    place = [c for c in ("block", "order") if c in statements.columns]
    return _code(statements).filter(F.col("statement").rlike(_INSERT_HEAD)).select(
        _unquoted(F.regexp_extract("statement", _INSERT_HEAD, 1)).alias("table"),
        "file",
        *place,
        F.col("statement").substr(F.length(F.regexp_extract("statement", _INSERT_HEAD, 0)) + 1, F.lit(2**31 - 1)).alias("body"),
        F.when(F.size(listed) > 0, F.transform(listed, _unquoted)).alias("listed"),
    )


def _tuples() -> Column:
    """The tuples of a value list; those in a clause after the values are not rows."""
    clause = rf"(?is)\A((?:[^()'\"]++|{_CALL})*?)\s*ON\s+DUPLICATE\s+KEY\s+UPDATE\b.*\z"
    body = F.col("body")
    values = F.when(F.upper(body).contains("DUPLICATE"), F.regexp_replace(body, clause, "$1")).otherwise(body)
    return F.regexp_extract_all(values, F.lit(_TUPLE), F.lit(1))


def _literals(tuple_: Column) -> Column:
    return F.regexp_extract_all(tuple_, F.lit(_VALUE), F.lit(1))


def insert_rows(statements: DataFrame) -> DataFrame:
    """One row per inserted tuple: table, file, its literals in order, as written, and the column list.

    Where the statements have a place, so have the rows: ``block``, ``order`` and ``at``, the number of the tuple.
    """
    found = inserts(statements)
    place = [c for c in ("block", "order") if c in found.columns]
    tuples = found.select("table", "file", *place, "listed", F.posexplode(_tuples()).alias("at", "tuple"))
    return tuples.select("table", "file", _literals(F.col("tuple")).alias("literals"), "listed", *([*place, "at"] if place else []))


def rejected(statements: DataFrame) -> DataFrame:
    """Statements that are not wholly understood: file, table (null if unknown) and statement.

    These are inserts that are not wholly made of tuples, such as cut-off ones, other forms
    of INSERT and REPLACE, routines outside of comments, and pieces that begin like no statement.
    Comments before a statement do not matter; a statement of nothing else is not one.
    """
    code = F.col("statement")
    is_insert, is_row = code.rlike(r"(?i)\A(?:INSERT|REPLACE)\b"), code.rlike(_INSERT_HEAD)
    rest = F.regexp_replace(F.regexp_replace(code, _INSERT_HEAD, ""), _TUPLE, "")
    known = code.rlike(rf"(?i)\A(?:{'|'.join(_OTHERS)})\b") & ~code.rlike(_ROUTINE)
    bad = (is_row & ~rest.rlike(_BETWEEN)) | (is_insert & ~is_row) | (~is_insert & ~known)
    name = F.when(is_row, _unquoted(F.regexp_extract(code, _INSERT_HEAD, 1)))
    return _code(statements).filter(bad).select("file", name.alias("table"), "statement")


def stage_rows(statements: DataFrame) -> DataFrame:
    """Insert rows, taken apart once and stored by table.

    A dump of many tables is then parsed in one pass, and reading one table touches
    only its own files.
    """
    path = stage_path(statements.sparkSession, "dump_rows")
    rows = insert_rows(statements)
    rows.write.partitionBy("table").parquet(path)
    kept = T.StructType([f for f in rows.schema if f.name != "table"] + [rows.schema["table"]])
    return statements.sparkSession.read.schema(kept).parquet(path)


def dump_table(
    rows: DataFrame,
    table: str,
    columns: list[str],
    schema: T.StructType | str | None = None,
    lenient: bool = False,
    position: bool = False,
) -> DataFrame:
    """Rows of one table under its column names, typed where the schema says so.

    Literals are decoded here, column by column; a column list of the INSERT says which is
    which, and a column that it leaves out is null. Short tuples are filled with nulls and
    surplus values dropped. ``lenient`` makes a value of the wrong type null instead of
    failing. ``position`` adds where the row stands in its file, statement and values, for rows of
    statements that have a place.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    types = {f.name: f.dataType for f in schema.fields} if schema is not None else {}

    def column(i: int, name: str) -> Column:
        at = F.when(F.col("listed").isNull(), F.lit(i)).otherwise(F.array_position("listed", name).cast("int") - 1)
        value, kind = sql_literal(F.get("literals", at)), types.get(name, T.StringType())
        return (value.try_cast(kind) if lenient else value.cast(kind)).alias(name)

    place = [F.struct("file", "block", F.col("order").alias("row"), "at").alias(POSITION)] if position else []
    return rows.filter(F.col("table") == table).select(*[column(i, c) for i, c in enumerate(columns)], *place)


def load_dump(
    spark: SparkSession,
    path: str,
    schemas: dict[str, T.StructType | str] | None = None,
    name_contains: str | None = None,
    lenient: bool = False,
    statement_end: str | None = None,
    skip_rejected: bool = False,
    position: bool = False,
) -> dict[str, DataFrame]:
    """Every table of a dump by name; tables without a definition get ``_c0``, ``_c1``, …

    A statement that is not wholly understood, a row with more values than its table or column list
    has columns, and a column list with an unknown name raise ``RejectedStatements``, so that no value is
    lost unseen. With ``skip_rejected`` such statements and surplus values are left out, and ``rejected`` and ``misfits``
    tell which. The dump is read once and stored as statements; these are read for what is
    rejected, for definitions and for rows. One row per table reaches the driver. Without a definition
    an INSERT's column list names the columns. ``position`` adds the place of each row (without ``statement_end``).
    """
    statements = read_statements(spark, path, name_contains, statement_end)
    if not skip_rejected and (bad := rejected(statements).select("file", F.substring("statement", 1, 80)).limit(3).collect()):
        raise RejectedStatements("; ".join(f"{file}: {begin!r}" for file, begin in bad))
    columns = {r["table"]: r["columns"] for r in table_columns(statements).collect()}
    rows = stage_rows(statements)
    widest = F.max(F.struct(F.size("literals").alias("width"), "listed"))
    found = rows.groupBy("table").agg(widest.alias("w")).collect()
    for r in found:
        if r["table"] not in columns:
            columns[r["table"]] = r["w"]["listed"] or [f"_c{i}" for i in range(r["w"]["width"])]
    if not skip_rejected and (bad := misfits(rows, columns).limit(3).collect()):
        raise RejectedStatements("; ".join(f"{r.file}: a row of {r.width} values for {r.room} columns of {r.table}" for r in bad))
    return {t: dump_table(rows, t, cols, (schemas or {}).get(t), lenient, position) for t, cols in columns.items()}


def misfits(rows: DataFrame, columns: dict[str, list[str]]) -> DataFrame:
    """Rows that do not fit: ``table file width room unknown``.

    Those with more values than their table or their column list has columns, those with fewer than their
    column list, and those whose column list names a column that the table has not.
    """
    defined = F.coalesce(*[F.when(F.col("table") == t, F.array(*map(F.lit, cols))) for t, cols in columns.items()], F.lit(None).cast("array<string>"))
    unknown = F.coalesce(F.array_except("listed", defined), F.array().cast("array<string>"))
    sized = rows.select(
        "table", "file", F.size("literals").alias("width"), F.size(F.coalesce("listed", defined)).alias("room"), unknown.alias("unknown"), "listed"
    )
    short = F.col("listed").isNotNull() & (F.col("width") < F.col("room"))
    return sized.filter((F.col("width") > F.col("room")) | short | (F.size("unknown") > 0)).drop("listed")


def dump_summary(statements: DataFrame) -> DataFrame:
    """Per table: number of columns, number of rows, column names."""
    counted = insert_rows(statements).groupBy("table").agg(F.count(F.lit(1)).alias("rows"))
    return (
        table_columns(statements)
        .join(counted, "table", "full")
        .select(
            "table",
            F.coalesce(F.size("columns"), F.lit(0)).alias("column_count"),
            F.coalesce("rows", F.lit(0)).cast("long").alias("row_count"),
            F.array_join("columns", ", ").alias("column_names"),
        )
    )


def load_report(statements: DataFrame) -> DataFrame:
    """Per table what a load would find: ``table columns rows too_wide rejected``; rejects of no table are under null.

    ``rows`` are those of the statements that are wholly understood, ``too_wide`` those of them with more values than
    columns. Nothing is brought to the driver.
    """
    defined = table_columns(statements).select("table", F.size("columns").alias("room"))
    rows = insert_rows(statements).select("table", F.size("literals").alias("width"), F.size("listed").alias("listed"))
    widths = rows.groupBy("table", "width", "listed").agg(F.count(F.lit(1)).alias("n")).join(defined, "table", "left")
    room = F.when(F.col("listed") > 0, F.col("listed")).otherwise(F.col("room"))
    counted = widths.groupBy("table").agg(F.sum("n").alias("rows"), F.sum(F.when(F.col("width") > room, F.col("n"))).alias("too_wide"))
    bad = rejected(statements).groupBy(F.col("table").alias("_bad")).agg(F.count(F.lit(1)).alias("rejected"))
    known = defined.join(counted, "table", "full")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return known.join(bad, F.col("table").eqNullSafe(F.col("_bad")), "full").select(
        F.coalesce("table", "_bad").alias("table"), F.col("room").alias("columns"), zero("rows"), zero("too_wide"), zero("rejected")
    )
