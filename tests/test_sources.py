import datetime as dt
import json
import tempfile

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from transhume import session
from transhume.sources import dump, lexer, tables


# -- CSV --------------------------------------------------------------------------------


def test_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text('b,extra,a\n"x ""q"", y",7,1\n,8,2\n"",9,3\n')
    df = tables.read_csv(spark, str(tmp_path / "t.csv"), "a int, b string, absent double")
    assert df.dtypes == [("b", "string"), ("extra", "string"), ("a", "int")]
    assert [tuple(r) for r in df.collect()] == [('x "q", y', "7", 1), (None, "8", 2), ("", "9", 3)]


def test_overrides_and_inference(spark, tmp_path):
    (tmp_path / "t.csv").write_text("discount,login\n100,0123\n99.9,D#1\n")
    path = str(tmp_path / "t.csv")
    df = tables.read_csv(spark, path, "discount int, login int", {"discount": "double", "login": "string"})
    assert [tuple(r) for r in df.collect()] == [(100.0, "0123"), (99.9, "D#1")]
    assert tables.read_csv(spark, path).dtypes == [("discount", "double"), ("login", "string")]


def test_strict_fails_and_tolerant_keeps_the_row(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,n\n1,5\n2,x\n3,\n")
    path = str(tmp_path / "t.csv")
    with pytest.raises((PySparkException, Py4JJavaError)):
        tables.read_csv(spark, path, "id int, n double", mode=tables.STRICT).collect()
    df = tables.read_csv(spark, path, "id int, n double", mode=tables.TOLERANT, corrupt_column="bad")
    assert [tuple(r) for r in df.collect()] == [(1, 5.0, None), (2, None, "2,x"), (3, None, None)]


def test_files_with_other_columns_are_refused(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n3,4\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        tables.read_csv(spark, str(tmp_path), "a int, b int").collect()


def test_line_breaks_in_cells(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb"), (2, " c ")], "id int, t string")
    tables.write_csv(df, str(tmp_path / "out"))
    back = tables.read_csv(spark, str(tmp_path / "out"), "id int, t string", multiline=True)
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a\nb"), (2, " c ")]


def test_timestamps_are_written_in_full(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 60),)], "t timestamp_ntz").coalesce(1)
    tables.write_csv(df, str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*.csv")).read_text()
    assert text == "t\n2024-01-02T03:04:05.000060\n"
    assert tables.read_csv(spark, str(tmp_path / "out"), "t timestamp_ntz").collect() == df.collect()


def test_empty_table(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n")
    df = tables.read_csv(spark, str(tmp_path / "t.csv"), "a int, b string")
    assert df.columns == ["a", "b"] and tables.row_count(df) == 0


def test_missing_sources(spark, tmp_path):
    path = str(tmp_path / "nowhere.csv")
    assert tables.read_optional(spark, path, "a int") is None
    with pytest.raises(PySparkException):
        tables.read_table(spark, path, "a int")


def test_parquet_twin(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    tables.write_parquet(spark.range(3), path)
    assert tables.read_table(spark, path).count() == 3


def test_column_lists(spark, tmp_path):
    (tmp_path / "list.json").write_text(json.dumps(["a", "b"], indent=1))
    (tmp_path / "object.json").write_text(json.dumps({"columns": ["c"]}))
    (tmp_path / "bad.json").write_text("[1, 2")
    (tmp_path / "other.json").write_text('{"x": 1}')
    assert tables.read_column_list(spark, str(tmp_path / "list.json")) == ["a", "b"]
    assert tables.read_column_list(spark, str(tmp_path / "object.json")) == ["c"]
    assert tables.read_column_list(spark, str(tmp_path / "none.json"), ["d"]) == ["d"]
    for name in ("bad.json", "other.json"):
        with pytest.raises(ValueError):
            tables.read_column_list(spark, str(tmp_path / name))


class _Session:
    """Just enough of a session to ask where staged tables go."""

    def __init__(self, folder, master):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_shared_folder_is_the_clusters(spark):
    assert session.shared_dir(_Session("hdfs://x/cp", "yarn")) == "hdfs://x/cp"
    assert session.shared_dir(_Session(None, "local[2]")).startswith(tempfile.gettempdir())
    with pytest.raises(ValueError):
        session.shared_dir(_Session(None, "yarn"))
    staged = session.stage(spark.range(5), "five")
    assert staged.count() == 5
    assert all(session.shared_dir(spark) in f for f in staged.inputFiles())


# -- dumps ------------------------------------------------------------------------------

LONG = "x" * 100_000 + "''" + "y" * 1000
DUMP = rf'''-- MySQL dump
/*!40101 SET NAMES utf8 */;
DROP TABLE IF EXISTS `notes`;
CREATE TABLE `notes` (
  `id` bigint NOT NULL,
  `body` varchar(20) DEFAULT 'x, (y)',
  `n` double,
  PRIMARY KEY (`id`),
  KEY `k` (`body`)
) ENGINE=InnoDB COMMENT='a `quoted` thing';

--
-- Dumping data
--
LOCK TABLES `notes` WRITE;
INSERT INTO `notes` VALUES (1,'it\'s; (a), "b"',1.5),(2,'it''s',NULL),(3,'NULL',-2),
(4,'',0),(5,'back\\slash\\n',1e3), (6, "dq ""x""" , 7 );
INSERT INTO `notes` VALUES (7,'short'),(8,'long',1,'surplus'),(9,'line\nbreak',2);
UNLOCK TABLES;
INSERT INTO loose VALUES (1,'a'),(2,'b',3);
insert into `notes` (`id`, `body`, `n`) values (10,'{LONG}',3);
INSERT INTO `notes` VALUES (11,'cut off
'''

EXPECTED = [
    (1, "it's; (a), \"b\"", 1.5),
    (2, "it's", None),
    (3, "NULL", -2.0),
    (4, "", 0.0),
    (5, "back\\slash\\n", 1000.0),
    (6, 'dq "x"', 7.0),
    (7, "short", None),
    (8, "long", 1.0),
    (9, "line\nbreak", 2.0),
    (10, LONG.replace("''", "'"), 3.0),
]


@pytest.fixture
def dump_path(tmp_path):
    (tmp_path / "site_notes.sql").write_text(DUMP)
    return str(tmp_path)


@pytest.mark.parametrize("split_bytes", ["134217728", "300"])
def test_dump_load(spark, dump_path, split_bytes):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        schemas = {"notes": "id bigint, body string, n double"}
        with pytest.raises(dump.RejectedStatements, match="cut off"):
            dump.load_dump(spark, dump_path, schemas)
        got = dump.load_dump(spark, dump_path, schemas, skip_rejected=True)
        assert sorted(got) == ["loose", "notes"]
        assert got["notes"].dtypes == [("id", "bigint"), ("body", "string"), ("n", "double")]
        assert sorted(tuple(r) for r in got["notes"].collect()) == EXPECTED
        assert sorted(tuple(r) for r in got["loose"].collect()) == [("1", "a", None), ("2", "b", "3")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_dump_columns_and_summary(spark, dump_path):
    statements = dump.read_statements(spark, dump_path)
    assert [tuple(r) for r in dump.table_columns(statements).collect()] == [("notes", ["id", "body", "n"])]
    got = {r["table"]: (r["column_count"], r["row_count"], r["column_names"]) for r in dump.dump_summary(statements).collect()}
    assert got == {"notes": (3, 10, "id, body, n"), "loose": (0, 2, None)}


def test_cut_off_statements_are_reported(spark, dump_path):
    bad = dump.rejected(dump.read_statements(spark, dump_path)).collect()
    assert [r["table"] for r in bad] == ["notes"]
    assert bad[0]["statement"].endswith("(11,'cut off")


def test_several_files_and_name_filter(spark, tmp_path):
    create = "CREATE TABLE `t` (\n  `a` int\n);\n"
    (tmp_path / "t_1.sql").write_text(create + "INSERT INTO `t` VALUES (1),(2);\n")
    (tmp_path / "t_2.sql").write_text("INSERT INTO `t` VALUES (3);\n")
    (tmp_path / "u_1.sql").write_text("INSERT INTO `u` VALUES (9);\n")
    (tmp_path / "readme.txt").write_text("INSERT INTO `t` VALUES (99);\n")
    both = dump.load_dump(spark, str(tmp_path))
    assert sorted(both) == ["t", "u"]
    only = dump.load_dump(spark, str(tmp_path), {"t": "a int"}, name_contains="t_")
    assert sorted(only) == ["t"]
    assert sorted(r.a for r in only["t"].collect()) == [1, 2, 3]
    single = dump.read_statements(spark, str(tmp_path / "t_2.sql"))
    assert dump.insert_rows(single).select(F.get("literals", F.lit(0))).first()[0] == "3"


def test_bad_values_in_a_dump(spark, tmp_path):
    (tmp_path / "t.sql").write_text("CREATE TABLE `t` (\n  `a` int\n);\nINSERT INTO `t` VALUES (1),('x');\n")
    strict = dump.load_dump(spark, str(tmp_path), {"t": "a int"})["t"]
    with pytest.raises((PySparkException, Py4JJavaError)):
        strict.collect()
    lenient = dump.load_dump(spark, str(tmp_path), {"t": "a int"}, lenient=True)["t"]
    assert {r.a for r in lenient.collect()} == {1, None}


def test_insert_text_inside_a_value_is_not_a_statement(spark, tmp_path):
    (tmp_path / "t.sql").write_text(
        "CREATE TABLE `t` (\n  `a` text\n);\nINSERT INTO `t` VALUES ('INSERT INTO `u` VALUES (1)'),('CREATE TABLE `v` (');\n"
    )
    got = dump.load_dump(spark, str(tmp_path))
    assert sorted(got) == ["t"]
    assert sorted(r.a for r in got["t"].collect()) == ["CREATE TABLE `v` (", "INSERT INTO `u` VALUES (1)"]


# -- nothing is lost without a word ------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("INSERT INTO `t` VALUES (1,'a');\r\nINSERT INTO `t` VALUES (2,'b');\r\n", [("1", "a"), ("2", "b")]),
        ("INSERT INTO t VALUES (1,'a'); \nINSERT INTO t VALUES (2,'b');  \n", [("1", "a"), ("2", "b")]),
        ("/* two\n lines; */\n-- and; one\nINSERT INTO `t` VALUES (1,'a');\nINSERT INTO t VALUES (2,'b');", [("1", "a"), ("2", "b")]),
        ("INSERT INTO `db`.`t` VALUES (1,'a');\nREPLACE INTO db.t VALUES (2,'b');\n", [("1", "a"), ("2", "b")]),
        ("INSERT INTO `t` VALUES (1,POINT(3,4)),(2,'y')", [("1", "POINT(3,4)"), ("2", "y")]),
        ("INSERT INTO `t` VALUES (1,_binary 'x;\r\ny'); \n", [("1", "x;\r\ny")]),
        ("INSERT INTO `t` VALUES (1,'a') ON DUPLICATE KEY UPDATE b = VALUES(b);\n", [("1", "a")]),
    ],
)
def test_forms_of_inserts(spark, tmp_path, text, want):
    (tmp_path / "d.sql").write_bytes(text.encode())
    got = dump.load_dump(spark, str(tmp_path))["t"]
    assert sorted(map(tuple, got.collect())) == want


def test_column_list_says_which_value_is_which(spark, tmp_path):
    (tmp_path / "d.sql").write_text("CREATE TABLE `t` (\n  `a` int,\n  `b` text,\n  `c` text\n);\nINSERT INTO `t` (`b`,`a`) VALUES ('x',1);\n")
    assert [r.asDict() for r in dump.load_dump(spark, str(tmp_path))["t"].collect()] == [{"a": "1", "b": "x", "c": None}]


@pytest.mark.parametrize(
    "text",
    [
        "CREATE TABLE `t` (`a` int, `b` text);\nINSERT INTO `t` VALUES (1,'a',3);\n",
        "CREATE TABLE `t` (`a` int, `b` text);\nINSERT INTO `t` (`a`,`c`) VALUES (1,'a');\n",
        "CREATE TABLE `t` (`a` int, `b` text);\nINSERT INTO `t` (`a`,`b`) VALUES (1);\n",
        "INSERT INTO `t` VALUES (1,'a') /*!50000 ,(2,'b') */;\n",
        "CREATE TRIGGER x BEFORE INSERT ON t FOR EACH ROW BEGIN INSERT INTO t VALUES (1,'a'); END;\n",
        "DELIMITER //\nCREATE PROCEDURE p() BEGIN INSERT INTO t VALUES (1,'a'); END //\n",
        "INSERT INTO `t` VALUES (1,'a'),(2,'b",
        "INSERT INTO `t` SELECT * FROM u;\n",
        "INSERT INTO `t` SET a = 1;\n",
    ],
)
def test_what_is_not_understood_raises(spark, tmp_path, text):
    (tmp_path / "d.sql").write_text(text)
    with pytest.raises(dump.RejectedStatements):
        dump.load_dump(spark, str(tmp_path))


ROWS = [("1", "x"), ("2", "y")]


@pytest.mark.parametrize(
    "definition",
    [
        "CREATE TABLE `t` (`a` int, `b` text);",
        "create table t (a int, b text)",
        "CREATE TABLE `t` (`a` int,\n`b` text\n);",
        "CREATE TABLE IF NOT EXISTS `shop`.`t` (\r\n  a decimal(10,2) DEFAULT '1,2' COMMENT 'x, (y',\r\n  `b` enum('p,q','r)') -- c, d\r\n, PRIMARY KEY (a, b), KEY k (b(10)), CHECK (a > 0))",
        "CREATE TABLE t (a int /* , z int */, b text, CONSTRAINT c FOREIGN KEY (a) REFERENCES u (x, y)) COMMENT='(q, r)'",
        "/*!40101 CREATE TABLE `t` (`a` int, `b` text) */;",
        '-- before\n/* and */ CREATE TABLE t ("a" int, b text);',
    ],
)
def test_definitions_name_the_columns(spark, tmp_path, definition):
    (tmp_path / "d.sql").write_bytes((definition.rstrip(";") + ";\nINSERT INTO `t` VALUES (1,'x'),(2,'y');\n").encode())
    got = dump.load_dump(spark, str(tmp_path))["t"]
    assert got.columns == ["a", "b"] and sorted(map(tuple, got.collect())) == ROWS


def test_quotes_and_commas_in_names(spark, tmp_path):
    (tmp_path / "d.sql").write_text("CREATE TABLE `a b` (`x, (y` int, `q``r` text);\nINSERT INTO `a b` (`q``r`,`x, (y`) VALUES ('v',1);\n")
    got = dump.load_dump(spark, str(tmp_path))
    assert list(got) == ["a b"] and got["a b"].first().asDict() == {"x, (y": "1", "q`r": "v"}


def test_surplus_values_are_cut_when_asked(spark, tmp_path):
    (tmp_path / "d.sql").write_text("CREATE TABLE t (a int, b text);\nINSERT INTO t VALUES (1,'x'),(2,'y',3),(4);\n")
    got = dump.load_dump(spark, str(tmp_path), skip_rejected=True)["t"]
    assert sorted(map(tuple, got.collect())) == [("1", "x"), ("2", "y"), ("4", None)]
    rows = dump.stage_rows(dump.read_statements(spark, str(tmp_path)))
    (bad,) = dump.misfits(rows, {"t": ["a", "b"]}).collect()
    assert (bad.table, bad.width, bad.room) == ("t", 3, 2)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("/*!50000 INSERT INTO `t` VALUES (1,'x') */;\nINSERT INTO `t` VALUES (2,'y');\n", ROWS),
        ("/*!40000 ALTER TABLE `t` DISABLE KEYS */;\nINSERT INTO t VALUES (1,'x');INSERT INTO t VALUES (2,'y')", ROWS),
        ("INSERT INTO `t` VALUES (1,'a;\nb'),(2,'c;');\n", [("1", "a;\nb"), ("2", "c;")]),
        ("INSERT INTO `t` VALUES (1,';;\\';'),(2,';''')\r\n;", [("1", ";;';"), ("2", ";'")]),
        ("-- it's; one\n# \"two; \n/* three'; */INSERT INTO `t` VALUES (1,\"x;'\"),(2,'--;\"');", [("1", "x;'"), ("2", '--;"')]),
        ("CREATE TABLE t (`;a` int, b text);INSERT INTO t VALUES (1,'/*;'),(5-3,'*/')", [("1", "/*;"), ("5-3", "*/")]),
        ("/*!50003 CREATE TRIGGER x BEGIN INSERT INTO t VALUES (8,'q'); END */;;\nDELIMITER ;\nINSERT INTO t VALUES (1,'x');", [("1", "x")]),
        ("INSERT INTO `t` VALUES (1,'" + "a;" * 100 + "'),(2,'y');", [("1", "a;" * 100), ("2", "y")]),
    ],
)
@pytest.mark.parametrize("split_bytes", ["134217728", "40"])
def test_statements_are_cut_in_any_split(spark, tmp_path, text, want, split_bytes):
    (tmp_path / "d.sql").write_bytes(text.encode())
    (tmp_path / "e.sql").write_text("INSERT INTO `u` VALUES (0);\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        pieces = lexer.read_pieces(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    statements = dump.as_statements(lexer.statements(pieces))
    assert dump.rejected(statements).count() == 0
    got = dump.dump_table(dump.insert_rows(statements), "t", ["a", "b"])
    assert sorted(map(tuple, got.collect())) == want


def test_a_file_with_other_line_ends_is_cut_in_many_tasks(spark, tmp_path):
    rows = [(str(i), "it's; " * (i % 5)) for i in range(3000)]
    quoted = [(a, b.replace("'", "''")) for a, b in rows]
    (tmp_path / "d.sql").write_bytes("".join(f"INSERT INTO t VALUES ({a},'{b}');  \r\n" for a, b in quoted).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        pieces = lexer.read_pieces(spark, str(tmp_path))
        assert pieces.select("block").distinct().count() > 5
        got = dump.load_dump(spark, str(tmp_path))["t"]
        assert sorted(map(tuple, got.collect())) == sorted(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


# -- whole scans -----------------------------------------------------------------------


def test_a_checked_scan_parses_cells_that_nobody_reads(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,n,day\n1,2,2020-01-01\n3,x,2020-01-02\n")
    schema = "id int, n int, day date"
    assert tables.read_csv(spark, str(tmp_path / "t.csv"), schema).select("id").count() == 2
    checked = tables.read_csv(spark, str(tmp_path / "t.csv"), schema, checked=True)
    for look in (checked.count, checked.select("id").collect, checked.where("id = 1").collect):
        with pytest.raises((PySparkException, Py4JJavaError)):
            look()
    (tmp_path / "t.csv").write_text("id,n,day\n1,2,2020-01-01\n3,,\n")
    good = tables.read_csv(spark, str(tmp_path / "t.csv"), schema, checked=True)
    assert good.count() == 2 and [r.id for r in good.select("id").collect()] == [1, 3]


def test_tolerated_cells_are_counted_by_column(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,n,day\n1,x,2020-01-01\ny,2,nope\n3,,\n4,"a ""b"", c",2020-01-02\n5,6\n')
    rows = tables.read_csv(spark, str(tmp_path), "id int, n int, day date", mode=tables.TOLERANT, corrupt_column="_raw")
    assert dict(tables.tolerated_cells(rows, "_raw").collect()) == {"id": 1, "n": 2, "day": 1}
    assert rows.count() == 5


def test_files_of_other_headers_meet_by_name(spark, tmp_path):
    for k, text in enumerate(("a,b\n1,x\n2,y\n", "b,a\r\nz,3\r\n", "a\n4\n", "a,b,c\n5,w,q\n", "a,b\n")):
        (tmp_path / f"{k}.csv").write_bytes(text.encode())
    assert sorted(len(g) for g in tables.files_by_header(spark, str(tmp_path))) == [1, 1, 1, 2]
    got = tables.read_csv_folder(spark, str(tmp_path), "a int, b string, c string", position=True).select("a", "b", "c")
    assert sorted(map(tuple, got.collect()), key=repr) == [(1, "x", None), (2, "y", None), (3, "z", None), (4, None, None), (5, "w", "q")]


def test_report_of_a_dump(spark, dump_path):
    got = {r.table: r.asDict() for r in dump.load_report(dump.read_statements(spark, dump_path)).collect()}
    assert {k: (v["columns"], v["rows"], v["too_wide"], v["rejected"]) for k, v in got.items()} == {"notes": (3, 10, 1, 1), "loose": (None, 2, 0, 0)}
