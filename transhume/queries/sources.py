"""Queries that read what they wrote: CSV tables and SQL dumps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transhume.operators import audit, conform, dedup, lookup
from transhume.plans import everything
from transhume.queries.inputs import derived
from transhume.queries.registry import query, table
from transhume.rulebook import AccountRules
from transhume.session import stage_path
from transhume.sources import dump, tables

_ORDERS = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string"
)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def csv_roundtrip(spark, sf_dir):
    path = stage_path(spark, "orders_csv")
    tables.write_csv(table(spark, sf_dir, "orders"), path)
    # The price is declared as text and overridden, as a source with a wrong base type would be.
    schema = _ORDERS.replace("o_totalprice double", "o_totalprice string")
    return tables.read_csv(spark, path, schema, overrides={"o_totalprice": "double"}, mode=tables.STRICT)


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN ''
              ELSE ' "' || c_name || '", x ' END AS note, c_custkey % 3 = 1 AS is_blank
       FROM customer"""
)
def csv_blank_and_null(spark, sf_dir):
    key = F.col("c_custkey")
    note = F.when(key % 3 == 1, F.lit("")).when(key % 3 == 2, F.concat(F.lit(' "'), F.col("c_name"), F.lit('", x ')))
    path = stage_path(spark, "notes_csv")
    tables.write_csv(table(spark, sf_dir, "customer").select("c_custkey", note.alias("note")), path)
    back = tables.read_csv(spark, path, "note string, c_custkey bigint")
    return back.select("c_custkey", "note", F.coalesce(F.col("note") == "", F.lit(False)).alias("is_blank"))


@query(
    """SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS BIGINT)
              AS o_custkey, o_orderpriority, o_orderkey % 7 = 0 AS had_bad_cell
       FROM orders"""
)
def tolerant_scan(spark, sf_dir):
    spoiled = F.when(F.col("o_orderkey") % 7 == 0, F.lit("n/a")).otherwise(F.col("o_custkey").cast("string"))
    path = stage_path(spark, "spoiled_csv")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", spoiled.alias("o_custkey"), "o_orderpriority")
    tables.write_csv(orders, path)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderpriority string"
    back = tables.read_csv(spark, path, schema, mode=tables.TOLERANT, corrupt_column="_bad")
    return back.withColumn("had_bad_cell", F.col("_bad").isNotNull()).drop("_bad")


@query("SELECT count(*) AS n FROM supplier")
def file_row_count(spark, sf_dir):
    path = stage_path(spark, "supplier_csv")
    tables.write_csv(table(spark, sf_dir, "supplier"), path)
    return tables.read_csv(spark, path, "s_suppkey bigint").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS note FROM supplier")
def optional_source(spark, sf_dir):
    notes = tables.read_optional(spark, f"{sf_dir}/supplier_notes_that_do_not_exist.csv", "s_suppkey bigint, note string")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    if notes is None:
        return suppliers.withColumn("note", F.lit(None).cast("string"))
    return suppliers.join(notes, "s_suppkey", "left")


def _literal(c: Column, text: bool) -> Column:
    """SQL literal of a value, as mysqldump writes it."""
    if not text:
        return F.coalesce(c.cast("string"), F.lit("NULL"))
    for plain, written in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(plain), F.lit(written))
    return F.coalesce(F.concat(F.lit("'"), c, F.lit("'")), F.lit("NULL"))


def write_dump(df: DataFrame, name: str, path: str, per_statement: Column | None = None) -> None:
    """Render a table as a dump: its definition, then INSERT statements.

    ``per_statement`` is a key whose groups are small by construction; without it every
    row is a statement of its own.
    """
    literals = [_literal(F.col(n), t == "string") for n, t in df.dtypes]
    row = F.concat(F.lit("("), F.concat_ws(",", *literals), F.lit(")"))
    if per_statement is None:
        bodies = df.select(row.alias("rows"))
    else:
        grouped = df.groupBy(per_statement.alias("__g")).agg(F.collect_list(row).alias("rows"))
        bodies = grouped.select(F.array_join("rows", ",\n").alias("rows"))
    inserts = bodies.select(F.concat(F.lit(f"INSERT INTO `{name}` VALUES "), "rows").alias("value"))
    lines = ",\n".join(f"  `{c}` text" for c in df.columns)
    create = f"-- Table {name}\n\nCREATE TABLE `{name}` (\n{lines},\n  PRIMARY KEY (`{df.columns[0]}`)\n) ENGINE=InnoDB"
    # Text files of several statements each; the definition comes in a file of its own.
    options = {"lineSep": ";\n"}
    inserts.write.mode("append").options(**options).text(path)
    df.sparkSession.range(1).select(F.lit(create).alias("value")).write.mode("append").options(**options).text(path)


def _dump_statements(spark, path: str) -> DataFrame:
    """Spark names its text files .txt, so they are read without the name filter."""
    raw = spark.read.option("lineSep", dump.STATEMENT_END).text(path)
    return dump.statements_of(raw.select("value", F.col("_metadata.file_path").alias("file")))


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def dump_load(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = stage_path(spark, "documents_dump")
    write_dump(docs, "documents", path)
    return dump.dump_table(dump.insert_rows(_dump_statements(spark, path)), "documents", docs.columns, docs.schema)


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN ''
              WHEN c_custkey % 4 = 2 THEN 'NULL' ELSE 'it''s (a); "b", \\n' END AS note, c_acctbal
       FROM customer"""
)
def dump_load_many_tuples(spark, sf_dir):
    key = F.col("c_custkey")
    note = F.when(key % 4 == 1, "").when(key % 4 == 2, "NULL").when(key % 4 == 3, "it's (a); \"b\", \\n")
    rows = table(spark, sf_dir, "customer").select("c_custkey", note.alias("note"), "c_acctbal")
    path = stage_path(spark, "customer_dump")
    write_dump(rows, "customer", path, per_statement=F.floor(key / 50))
    staged = dump.stage_rows(_dump_statements(spark, path))
    return dump.dump_table(staged, "customer", rows.columns, rows.schema)


@query(
    """SELECT 'supplier' AS "table", 4 AS column_count, count(*) AS row_count,
              's_suppkey, s_name, s_nationkey, s_acctbal' AS column_names FROM supplier
       UNION ALL
       SELECT 'nation', 3, count(*), 'n_nationkey, n_name, n_regionkey' FROM nation"""
)
def dump_summary(spark, sf_dir):
    path = stage_path(spark, "two_tables_dump")
    write_dump(table(spark, sf_dir, "supplier"), "supplier", path, per_statement=F.floor(F.col("s_suppkey") / 20))
    write_dump(table(spark, sf_dir, "nation"), "nation", path)
    return dump.dump_summary(_dump_statements(spark, path))


@query(
    """SELECT 'supplier' AS "table", 's_suppkey' AS first_column, 4 AS n_columns"""
    """ FROM (SELECT count(*) AS n FROM supplier) WHERE n > 0"""
)
def dump_columns(spark, sf_dir):
    path = stage_path(spark, "supplier_dump")
    write_dump(table(spark, sf_dir, "supplier"), "supplier", path)
    found = dump.table_columns(_dump_statements(spark, path))
    return found.select("table", F.get("columns", F.lit(0)).alias("first_column"), F.size("columns").alias("n_columns"))


def _as_sql_files(spark, path: str) -> None:
    """Spark names its text files .txt; a dump's are named .sql."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for i, status in enumerate(fs.listStatus(folder)):
        if status.getPath().getName().endswith(".txt"):
            fs.rename(status.getPath(), hadoop.Path(folder, f"{status.getPath().getParent().getName()}_{i}.sql"))


@query("SELECT s_suppkey, s_name, s_nationkey, 'POINT(' || s_suppkey || ',1)' AS place, s_acctbal FROM supplier")
def dump_load_files(spark, sf_dir):
    """Files of a dump by name: CRLF, blanks and comments around statements, calls, a column list in other order."""
    rows = table(spark, sf_dir, "supplier")
    path = stage_path(spark, "supplier_dump")
    names = "`s_acctbal`, `s_suppkey`, `place`, `s_nationkey`, `s_name`"
    place = F.concat(F.lit("POINT("), "s_suppkey", F.lit(",1)"))
    values = F.concat_ws(", ", F.col("s_acctbal").cast("string"), "s_suppkey", place, "s_nationkey", _literal(F.col("s_name"), True))
    insert = F.concat(
        F.lit("-- one; row\r\n/* of\r\n several; */\r\nINSERT INTO `shop`.`supplier` ("), F.lit(names), F.lit(") VALUES\r\n("), values, F.lit(");  \r")
    )
    rows.select(insert.alias("value")).write.text(path)
    lines = ",\n".join(f"  `{c}` text" for c in ("s_suppkey", "s_name", "s_nationkey", "place", "s_acctbal"))
    create = f"/*!40101 SET NAMES utf8 */;\nCREATE TABLE `supplier` (\n{lines}\n) ENGINE=InnoDB;"
    spark.range(1).select(F.lit(create).alias("value")).write.mode("append").text(path)
    _as_sql_files(spark, path)
    types = rows.schema
    typed = ", ".join(f"{c} {types[c].dataType.simpleString() if c in types.names else 'string'}" for c in ("s_suppkey", "s_name", "s_nationkey", "place", "s_acctbal"))
    return dump.load_dump(spark, path, {"supplier": typed}, name_contains="supplier")["supplier"]


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'it''s;' || chr(13) || chr(10) || '"' || c_name || '"; -- no' END AS note,
              c_acctbal
       FROM customer"""
)
def dump_load_definitions(spark, sf_dir):
    """A definition on one line with bare names, statements with other line ends, semicolons and line ends in literals."""
    key = F.col("c_custkey")
    note = F.when(key % 3 != 0, F.concat(F.lit("it's;\r\n\""), F.col("c_name"), F.lit('"; -- no')))
    rows = table(spark, sf_dir, "customer").select("c_custkey", note.alias("note"), "c_acctbal")
    path = stage_path(spark, "customer_dump")
    text = F.concat(F.lit("'"), F.replace("note", F.lit("'"), F.lit("''")), F.lit("'"))
    values = F.concat_ws(", ", F.col("c_custkey").cast("string"), F.coalesce(text, F.lit("NULL")), F.col("c_acctbal").cast("string"))
    held = F.concat(F.lit("/*!50000 INSERT INTO customer VALUES ("), values, F.lit(") */;; \r"))
    insert = F.concat(F.lit("/* one; it's */ insert into `customer` values ("), values, F.lit(");  \r"))
    rows.select(F.when(key % 5 == 0, held).otherwise(insert).alias("value")).write.text(path)
    create = "create table customer (c_custkey bigint, note varchar(99) default 'a, (b', c_acctbal double, primary key (c_custkey));"
    spark.range(1).select(F.lit(create).alias("value")).write.mode("append").text(path)
    _as_sql_files(spark, path)
    return dump.load_dump(spark, path, {"customer": rows.schema})["customer"]


@query(
    """SELECT o_custkey, min(o_orderkey) AS first_order, max(o_orderkey) AS last_order,
              max_by(o_orderpriority, o_orderkey) AS last_priority
       FROM orders GROUP BY o_custkey"""
)
def input_position(spark, sf_dir):
    """Of the rows of each customer the first and the last, as a folder of files holds them."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    path = stage_path(spark, "orders_csv")
    tables.write_csv(orders.repartitionByRange(4, "o_orderkey").sortWithinPartitions("o_orderkey"), path)
    back = tables.read_csv(spark, path, orders.schema, position=True)
    firsts = dedup.keep_first(back, ["o_custkey"], [tables.POSITION]).select("o_custkey", F.col("o_orderkey").alias("first_order"))
    taken = {"last_order": "o_orderkey", "last_priority": "o_orderpriority"}
    return lookup.lookup(firsts, back, "o_custkey", "o_custkey", taken, last_by=[tables.POSITION])


@query("SELECT 'written' AS step, count(*) AS n, count(DISTINCT n_regionkey) AS regions FROM nation")
def publish_and_count(spark, sf_dir):
    """A table replaced by its sink, with the counts that the writing job made."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    folder, counts = stage_path(spark, "published"), audit.Counts()
    sink = tables.parquet_sink(folder)
    sink(nations.limit(0), "nation")
    back = sink(counts.watch(nations, "written"), "nation")
    n = counts.taken()["written"]
    return back.agg(F.countDistinct("n_regionkey").alias("regions")).select(F.lit("written").alias("step"), F.lit(n).cast("long").alias("n"), "regions")


@query(
    """SELECT 'o_custkey' AS "column", count(*) FILTER (o_orderkey % 7 = 0) AS cells FROM orders
       UNION ALL SELECT 'o_orderdate', count(*) FILTER (o_orderkey % 5 = 0) FROM orders
       UNION ALL SELECT 'o_orderkey', 0 UNION ALL SELECT 'o_orderpriority', 0"""
)
def tolerated_cells(spark, sf_dir):
    """Cells of the wrong type per column of a scan that tolerates them; empty and missing cells are none."""
    key = F.col("o_orderkey")
    spoiled = F.when(key % 7 == 0, "n/a").when(key % 7 == 1, None).otherwise(F.col("o_custkey").cast("string"))
    day = F.when(key % 5 == 0, 'on "a", day').otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    path = stage_path(spark, "spoiled_csv")
    tables.write_csv(table(spark, sf_dir, "orders").select("o_orderkey", spoiled.alias("o_custkey"), day.alias("o_orderdate"), "o_orderpriority"), path)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderdate date, o_orderpriority string"
    return tables.tolerated_cells(tables.read_csv(spark, path, schema, mode=tables.TOLERANT, corrupt_column="_bad"), "_bad")


@query("SELECT count(*) AS n, sum(o_custkey)::BIGINT AS total FROM orders")
def checked_scan(spark, sf_dir):
    """A strict scan that parses every cell, whatever is asked of it."""
    path = stage_path(spark, "orders_csv")
    tables.write_csv(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"), path)
    schema = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz"
    back = tables.read_csv(spark, path, schema, checked=True)
    return back.agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("total"))


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 3 <> 2 THEN c_name END AS c_name, CASE WHEN c_custkey % 3 <> 1 THEN c_acctbal END AS c_acctbal
       FROM customer"""
)
def csv_many_headers(spark, sf_dir):
    """A folder of CSV files with three headers: other order, and columns that some lack."""
    rows, path = table(spark, sf_dir, "customer"), stage_path(spark, "customer_csv")
    for k, columns in enumerate((["c_custkey", "c_name", "c_acctbal"], ["c_name", "c_custkey"], ["c_acctbal", "c_custkey"])):
        rows.where(F.col("c_custkey") % 3 == k).select(*columns).write.mode("append").option("header", "true").csv(path)
    return tables.read_csv_folder(spark, path, "c_custkey bigint, c_name string, c_acctbal double").select("c_custkey", "c_name", "c_acctbal")


@query("SELECT s_name, s_suppkey FROM supplier")
def column_list(spark, sf_dir):
    """The columns that a JSON file lists, in its order; a name that the table lacks is passed over."""
    rows, path = table(spark, sf_dir, "supplier"), stage_path(spark, "columns_json")
    listed = F.to_json(F.struct(F.array(F.lit("s_name"), F.lit("no_such_column"), F.lit("s_suppkey")).alias("columns")))
    spark.range(1).select(listed.alias("value")).coalesce(1).write.text(path)
    return conform.select_available(rows, tables.read_column_list(spark, path))


@query(
    """SELECT 'supplier' AS "table", 4 AS columns, count(*) AS "rows", count(*) FILTER (s_suppkey % 4 = 0) AS too_wide,
              count(*) FILTER (s_suppkey % 10 = 0) AS rejected
       FROM supplier"""
)
def dump_report(spark, sf_dir):
    """What a load of a spoiled dump would find: rows, rows that are too wide, statements that are cut off."""
    rows, path = table(spark, sf_dir, "supplier"), stage_path(spark, "spoiled_dump")
    key = F.col("s_suppkey")
    values = F.concat_ws(",", key.cast("string"), _literal(F.col("s_name"), True), F.col("s_nationkey").cast("string"), F.col("s_acctbal").cast("string"))
    insert = F.concat(F.lit("INSERT INTO supplier VALUES ("), values, F.when(key % 4 == 0, ",'more')").otherwise(")"))
    cut = F.concat(F.lit("INSERT INTO supplier VALUES ("), values, F.lit(",("))
    each = rows.select(F.explode(F.when(key % 10 == 0, F.array(insert, cut)).otherwise(F.array(insert))).alias("value"))
    each.write.option("lineSep", ";\n").text(path)
    create = "CREATE TABLE supplier (s_suppkey bigint, s_name text, s_nationkey int, s_acctbal double)"
    spark.range(1).select(F.lit(create).alias("value")).write.option("lineSep", ";\n").mode("append").text(path)
    return dump.load_report(_dump_statements(spark, path))


@query(
    """SELECT 'default_settings' AS "table", false AS ok, 'needs default_settings' AS error, 0 AS n FROM region WHERE r_regionkey = 0
       UNION ALL SELECT 'users', true, NULL, count(*) FROM customer"""
)
def outcomes_of_absent_sources(spark, sf_dir):
    """An export without its source is left out and says so; the others are made."""
    users = derived(spark, sf_dir, "users")
    folder = stage_path(spark, "some_exports")
    _, outcomes = everything.run_all(
        {"users": users}, AccountRules("demo\\Acme"), "nobody@example.com", [], tables.parquet_sink(folder), dt.datetime(2024, 7, 1),
        only=["users", "default_settings"],
    )
    lines = [(o.name, o.ok, o.error, o.counts["written"] if o.ok else 0) for o in outcomes]
    return spark.createDataFrame(lines, "`table` string, ok boolean, error string, n long")
