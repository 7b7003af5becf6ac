"""Random inputs against plain Python."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from transhume.functions.parse import sql_literal
from transhume.operators import audit, dedup, lookup
from transhume.queries.sources import write_dump
from transhume.session import stage_path
from transhume.sources import dump

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
TEXT = st.text(st.sampled_from("ab'\"\\nt0%_;,()\n\t \r`é😀N"), max_size=12)
KEY = st.one_of(st.none(), st.sampled_from("abc"), st.just("hot"))


@FEW
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=60))
def test_dump_gives_back_any_text(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, body string")
    path = stage_path(spark, "random_dump")
    write_dump(df, "t", path, per_statement=F.lit(1))
    raw = spark.read.option("lineSep", ";\n").text(path)
    statements = raw.select(F.col("value").alias("statement"), F.col("_metadata.file_path").alias("file"))
    back = dump.dump_table(dump.insert_rows(statements), "t", ["id", "body"], "id int, body string")
    assert sorted((r.id, r.body) for r in back.collect()) == list(enumerate(texts))
    assert dump.rejected(statements).count() == 0


@FEW
@given(st.lists(TEXT, min_size=1, max_size=60))
def test_doubled_quotes_in_both_kinds_of_literal(spark, texts):
    rows = []
    for i, t in enumerate(texts):
        plain = t.replace("\\", "")
        quote = "'" if i % 2 else '"'
        rows.append((quote + plain.replace(quote, quote * 2) + quote, plain))
    df = spark.createDataFrame(rows, "written string, meant string")
    assert df.filter(~sql_literal(F.col("written")).eqNullSafe(F.col("meant"))).count() == 0


@FEW
@given(st.lists(KEY, max_size=80), st.sampled_from(["collapse", "keep", "drop"]))
def test_keep_first(spark, keys, mode):
    df = spark.createDataFrame(list(enumerate(keys)), "id int, k string").repartition(3)
    first = {}
    for i, k in enumerate(keys):
        first.setdefault(k, i)
    expected = set(first.values()) if mode == "collapse" else {i for k, i in first.items() if k is not None}
    if mode == "keep":
        expected |= {i for i, k in enumerate(keys) if k is None}
    assert {r.id for r in dedup.keep_first(df, ["k"], ["id"], mode).collect()} == expected


@FEW
@given(
    st.lists(KEY, max_size=80),
    st.dictionaries(st.sampled_from(["a", "b", "hot", "z"]), st.one_of(st.none(), st.just("v"))),
    st.booleans(),
    st.booleans(),
)
def test_lookup(spark, keys, table, inner, salted):
    facts = spark.createDataFrame(list(enumerate(keys)), "id int, k string")
    dim = spark.createDataFrame(list(table.items()), "key string, v string")
    got = lookup.lookup(
        facts, dim, "k", "key", {"v": "v"}, unique=True, inner=inner,
        salt_hot=F.col("id") if salted else None, hot_rows=5,
    )
    expected = [(i, k, table.get(k)) for i, k in enumerate(keys) if not inner or k in table]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(expected, key=repr)


@FEW
@given(st.lists(KEY, max_size=80))
def test_duplicate_counts(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    assert tuple(audit.duplicate_counts(df, ["k"]).first()) == (len(keys), len(set(keys)), len(keys) - len(set(keys)))
