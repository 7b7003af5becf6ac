import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from transhume import rulebook
from transhume.functions.keys import code_from, random_code, random_uuid, uuid_from
from transhume.functions.parse import SECONDS_SHAPE, as_date, as_timestamp, sql_literal, try_timestamp
from transhume.operators import audit, conform, dedup, filters, lookup, rules


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- keys ------------------------------------------------------------------------------


def test_uuid_is_stable_and_well_formed(spark):
    df = spark.range(200).select(uuid_from("users", "id").alias("u"), uuid_from("other", "id").alias("o"))
    got = [r.u for r in df.collect()]
    assert got == [r.u for r in df.collect()]
    assert len(set(got)) == 200
    assert not set(got) & {r.o for r in df.collect()}
    assert df.filter(~F.col("u").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).count() == 0


def test_uuid_tells_key_parts_apart(spark):
    df = spark.createDataFrame([(1, 1, None), (2, None, 1), (3, None, None)], "n int, a int, b int")
    assert df.select(uuid_from("t", "a", "b")).distinct().count() == 3


def test_uuid_tells_texts_with_separators_apart(spark):
    rows = [("a:b", "c"), ("a", "b:c"), ("a|1:b", None), ("a", "1:b"), (None, "N"), ("N", None), ("\\N", None)]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.select(uuid_from("t", "a", "b")).distinct().count() == len(rows)


def test_codes_hardly_repeat(spark):
    made = spark.range(1_000_000).select(code_from("c", "id").alias("c"), random_code().alias("r"))
    counts = made.agg(F.countDistinct("c"), F.countDistinct("r")).first()
    assert min(counts) >= 999_995


def test_random_keys_are_unique_and_codes_alphanumeric(spark):
    df = spark.range(500).select(random_uuid().alias("u"), random_code().alias("r"), code_from("c", "id").alias("c"))
    got = df.collect()
    assert len({r.u for r in got}) == 500
    assert all(len(c) == 8 and c.isalnum() and c == c.upper() for r in got for c in (r.r, r.c))


# -- parsing ---------------------------------------------------------------------------


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_parsing_fails_on_bad_text_in_both_modes(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("2024-02-30 00:00:00",)], "t string")
        for column in (as_date(F.col("t")), as_timestamp(F.col("t")), as_timestamp(F.col("t"), SECONDS_SHAPE)):
            with pytest.raises(PySparkException):
                df.select(column).collect()
        assert df.select(try_timestamp(F.col("t"))).first()[0] is None
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_shape_is_part_of_strict_parsing(spark):
    df = spark.createDataFrame([("2024-01-02",)], "t string")
    assert df.select(as_timestamp(F.col("t"))).first()[0] == dt.datetime(2024, 1, 2)
    with pytest.raises(PySparkException):
        df.select(as_timestamp(F.col("t"), SECONDS_SHAPE)).collect()


def test_parsing_keeps_null_and_reads_both_separators(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("2024-01-02T03:04:05",), (None,)], "t string")
    at = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert [r[0] for r in df.select(as_timestamp(F.col("t"))).collect()] == [at, at, None]


@pytest.mark.parametrize(
    "written, meant",
    [
        ("NULL", None),
        ("null", None),
        ("'NULL'", "NULL"),
        ("''", ""),
        (" 12.5 ", "12.5"),
        (r"'it\'s'", "it's"),
        ("'it''s'", "it's"),
        (r"'a\\nb'", r"a\nb"),
        (r"'a\nb'", "a\nb"),
        (r"'\\\\'", "\\\\"),
        (r"'\\\'x\\'", "\\'x\\"),
        (r"'tab\there'", "tab\there"),
        (r"'\%\q'", "%q"),
        ('"say ""hi"""', 'say "hi"'),
        ("'a (b), c; d'", "a (b), c; d"),
    ],
)
def test_sql_literals(spark, written, meant):
    assert spark.createDataFrame([(written,)], "v string").select(sql_literal(F.col("v"))).first()[0] == meant


# -- projections -------------------------------------------------------------------------


def test_soft_and_strict_selection(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert conform.select_available(df, ["b", "x", "a"]).columns == ["b", "a"]
    assert conform.select_available(df, None).columns == ["a", "b"]
    assert conform.missing_columns(df, ["b", "x"]) == ["x"]
    with pytest.raises(ValueError, match="x"):
        conform.select_required(df, ["b", "x"])


def test_drop_and_move(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    with pytest.raises(ValueError):
        conform.drop_required(df, ["a", "x"])
    assert conform.drop_if_present(df, ["a", "x"]).columns == ["b", "c"]
    assert conform.move_before(df, "c", "a").columns == ["c", "a", "b"]
    assert conform.move_before(df, "x", "a").columns == ["a", "b", "c"]


def test_defaults_do_not_replace_and_fill_does(spark):
    df = spark.createDataFrame([(None, 2)], "a int, b int")
    got = conform.fill_cast(conform.with_defaults(df, {"b": F.lit(9), "c": F.lit(7)}), {"d": "a", "e": "x"})
    assert got.first().asDict() == {"a": None, "b": 2, "c": 7, "d": 0, "e": 0}


def test_blank_redact_and_casts(spark):
    df = spark.createDataFrame([("", "pw", "2024-01-02", "5", 2)], "a string, p string, d string, n string, f int")
    df = conform.redact(conform.blanks_to_null(df, ["a", "x"]), ["p", "x"])
    got = conform.cast_columns(df, {"d": "date", "n": "bigint", "f": "boolean", "x": "int"}).first()
    assert tuple(got) == (None, None, dt.date(2024, 1, 2), 5, True)


def test_lenient_cast(spark):
    df = spark.createDataFrame([("n/a",)], "n string")
    assert conform.cast_columns(df, {"n": "double"}, lenient=True).first()[0] is None


# -- filters -----------------------------------------------------------------------------


def test_prefix_and_membership_treat_null_as_sql_does(spark):
    df = spark.createDataFrame([("D#1",), ("1",), (None,)], "login string")
    assert rows(filters.exclude_prefix(df, "login", "D#")) == [("1",)]
    assert rows(filters.drop_members(df, "login", ["1"])) == [("D#1",)]
    assert filters.drop_members(df, "login", []).count() == 3


def test_cutoffs_include_the_limit(spark):
    at = dt.datetime(2024, 7, 1, 12)
    limit = at - dt.timedelta(days=180)
    df = spark.createDataFrame([(1, limit), (2, limit - dt.timedelta(seconds=1)), (3, None)], "id int, t timestamp_ntz")
    assert [r.id for r in filters.since_days(df, "t", at).collect()] == [1]
    assert [r.id for r in filters.since_date(df, dt.date(2024, 1, 3)).collect()] == [1, 2]
    assert filters.since_date(df, dt.date(2024, 1, 4)).count() == 0
    with pytest.raises(ValueError):
        filters.since_date(df.select("id"), dt.date(2024, 1, 1))


@pytest.mark.parametrize("key, expected", [("12", [12]), (12, [12]), ("012", []), ("x", []), ("", [])])
def test_slice_compares_as_text(spark, key, expected):
    df = spark.createDataFrame([(12,), (13,)], "k bigint")
    assert [r.k for r in filters.slice_by_key(df, "k", key).collect()] == expected


def test_slice_of_text_and_numbers(spark):
    df = spark.createDataFrame([("012", 1.5)], "s string, d double")
    assert filters.slice_by_key(df, "s", "12").count() == 0
    assert filters.slice_by_key(df, "s", "012").count() == 1
    assert filters.slice_by_key(df, "d", "1.5").count() == 1


# -- rules ------------------------------------------------------------------------------

G = "demo\\Acme\\U-"
GOLDEN = [
    ("123456", G + "DAG-1-B", None, 1, 1, 1, 0),
    ("123457", G + "SAG-2-A", None, 0, 2, 0, 0),
    ("123458", G + "FTF-1-A", "2024-01-15", 1, 0, 1, 1),
    ("123459", G + "DAG-1-B", "2024-01-15", 1, 1, 2, 0),
    ("123460", G + "DAG-1-B", "2024-01-15", 0, 1, 0, 2),
    ("e1", G + "FTF-1-A", "2024-01-15", 0, 1, None, None),
    ("e2", G + "DST-2-B", "2024-01-15", None, 2, 2, 0),
    ("e3", None, "2024-01-15", 1, 1, None, None),
    ("e4", G + "DAG-3-A", None, None, 3, None, 0),
]


def test_funded_state_golden_rows(spark):
    names = rulebook.AccountRules("demo\\Acme")
    df = spark.createDataFrame([g[:4] for g in GOLDEN], "login string, grp string, funded_at string, active int")
    state = rules.funded_state(
        rules.phase_of(F.col("grp"), rulebook.PHASE_MARKS),
        F.col("funded_at"),
        F.col("grp").isin(list(names.funded)),
        F.col("active"),
    )
    got = df.select("login", *[c.alias(n) for n, c in state.items()]).collect()
    assert [tuple(r) for r in got] == [(g[0], *g[4:]) for g in GOLDEN]


def test_funded_groups_are_two_per_programme():
    names = rulebook.AccountRules("demo\\Acme")
    assert len(names.funded) == 16
    assert names.funded[0] == G + "FTF-1-A" and names.funded[-1] == G + "TAF-1-B"


def test_target_group_prefers_competition(spark):
    df = spark.createDataFrame(
        [("COMPETITION", "x", True, 1), ("challenge", "x", True, 1), (None, "x", None, 1), (None, None, True, 1)],
        "action string, funded_at string, inside boolean, active int",
    )
    target = rules.target_group(
        F.col("action"), F.col("funded_at"), F.col("inside"), F.col("active"), "COM", "FND", "EVL"
    )
    assert [r[0] for r in df.select(target).collect()] == ["COM", "FND", "EVL", "EVL"]


def test_first_phase_mark_wins_and_default_applies(spark):
    df = spark.createDataFrame([("a 1-A 2-A",), ("3-B",), ("none",), (None,)], "g string")
    assert [r[0] for r in df.select(rules.phase_of(F.col("g"), rulebook.PHASE_MARKS)).collect()] == [1, 3, 1, 1]


def test_code_maps(spark):
    df = spark.createDataFrame([(0,), (4,), (9,), (None,)], "c int")
    stage = rules.code_map(F.col("c"), rulebook.ACCOUNT_STAGES, "trial")
    changed = rules.remap(F.col("c"), {4: 5})
    got = df.select(stage, changed, rules.two_way(F.col("c") == 0, "y", "n"), rules.number_text(F.col("c"))).collect()
    assert [tuple(r) for r in got] == [
        ("trial", 0, "y", "0"),
        ("instant", 5, "n", "4"),
        ("trial", 9, "n", "9"),
        ("trial", None, "n", None),
    ]


# -- dedup ------------------------------------------------------------------------------


def test_keep_first_modes(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "id int, k string")
    kept = {m: [r[0] for r in rows(dedup.keep_first(df, ["k"], ["id"], m))] for m in ("collapse", "keep", "drop")}
    assert kept == {"collapse": [1, 3], "keep": [1, 3, 4], "drop": [1]}
    with pytest.raises(ValueError):
        dedup.keep_first(df, ["k"], ["id"], "some")


def test_preferred_row_wins_else_first(spark):
    accounts = spark.createDataFrame(
        [(1, "A", 10), (2, "B", 10), (3, "C", 20), (4, "D", 20), (5, "E", None), (6, "F", None)],
        "id int, login string, purchase_id bigint",
    )
    prefs = spark.createDataFrame([("A", 10), ("B", 10), ("Z", 20), ("F", None)], "login string, purchase_id bigint")
    flagged = dedup.flag_preferred(accounts, prefs, "purchase_id", "login", "p")
    assert [r.id for r in flagged.filter("p").collect()] == [2]
    kept = dedup.keep_preferred(flagged, ["purchase_id"], ["id"], F.col("p"))
    assert sorted(r.id for r in kept.collect()) == [2, 3, 5]


def test_input_order_restores_file_order(spark, tmp_path):
    lines = [f"{i % 7},{i}" for i in range(1000)]
    (tmp_path / "t.csv").write_text("k,n\n" + "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        df = dedup.with_input_order(spark.read.schema("k int, n int").csv(str(tmp_path / "t.csv"), header=True))
        got = dedup.keep_first(df, ["k"], ["__file", "__block", "__row"]).select("k", "n")
        assert rows(got) == [(k, k) for k in range(7)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


# -- lookups ----------------------------------------------------------------------------


@pytest.fixture
def facts(spark):
    return spark.createDataFrame([(i, "hot" if i % 3 else str(i % 5)) for i in range(300)] + [(900, None)], "id int, k string")


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([("hot", "H"), ("0", "zero"), ("1", None), (None, "null")], "key string, v string")


def brute(facts, dim, inner=False, required=False):
    table = {r.key: r.v for r in dim.collect() if r.key is not None}
    if required:
        table = {k: v for k, v in table.items() if v is not None}
    return sorted(
        (
            (r.id, r.k, table.get(r.k))
            for r in facts.collect()
            if not inner or r.k in table
        ),
        key=repr,
    )


@pytest.mark.parametrize("inner", [False, True])
@pytest.mark.parametrize("required", [False, True])
@pytest.mark.parametrize("salted", [False, True])
def test_lookup_against_brute_force(spark, facts, dim, shuffled_joins, inner, required, salted):
    got = lookup.lookup(
        facts, dim, "k", "key", {"v": "v"}, unique=True, inner=inner, required=["v"] if required else [],
        salt_hot=F.col("id") if salted else None, hot_rows=20,
    )
    assert got.columns == ["id", "k", "v"]
    assert rows(got) == brute(facts, dim, inner, required)


def test_last_of_repeated_keys_wins(spark):
    facts = spark.createDataFrame([(1,), (2,)], "k int")
    dim = spark.createDataFrame([(1, 1, "old"), (2, 1, "new"), (3, 2, None)], "n int, key int, v string")
    assert rows(lookup.lookup(facts, dim, "k", "key", {"v": "v"}, last_by=["n"])) == [(1, "new"), (2, None)]
    with pytest.raises(ValueError):
        lookup.lookup(facts, dim, "k", "key", {"v": "v"})


def test_lookup_replaces_columns_of_the_same_name(spark):
    facts = spark.createDataFrame([(1, "old", 5)], "k int, v string, n int")
    dim = spark.createDataFrame([(1, "new", 7)], "key int, v string, k int")
    got = lookup.lookup(facts, dim, "k", "key", {"v": "v", "k": "k"}, unique=True).first().asDict()
    assert got == {"n": 5, "v": "new", "k": 7}


def test_text_lookup_keeps_leading_zeros_apart(spark):
    facts = spark.createDataFrame([("7",), ("07",)], "k string")
    dim = spark.createDataFrame([(7, "x")], "key bigint, v string")
    got = lookup.lookup(facts, dim, "k", "key", {"v": "v"}, text=True, unique=True)
    assert rows(got) == [("07", None), ("7", "x")]


def test_two_hop_reaches_the_survivor_and_null_codes(spark):
    purchases = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 9), (5, None)], "id int, discount_id int")
    codes = spark.createDataFrame([(1, "A"), (2, "A"), (3, None)], "id int, code string")
    survivors = spark.createDataFrame([("A", "u1"), (None, "u3")], "code string, uuid string")
    got = lookup.lookup_two_hop(purchases, codes, survivors, "discount_id", "id", "code", "code", {"d": "uuid"})
    assert {r.id: r.d for r in got.collect()} == {1: "u1", 2: "u1", 3: "u3", 4: None, 5: None}


def test_composite_join_and_uniqueness(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, None, 1)], "id int, x string, y int")
    dim = spark.createDataFrame([("a", 1, "u")], "x string, y int, uuid string")
    assert [r.id for r in lookup.composite_join(df, dim, ["x", "y"], {"u": "uuid"}).collect()] == [1]
    assert lookup.require_unique(dim, ["x", "y"]) is dim
    with pytest.raises(ValueError, match="repeated"):
        lookup.require_unique(dim.union(dim), ["x", "y"])
    taken = {"u": "uuid"}
    assert [r.id for r in lookup.composite_join(df, dim, ["x", "y"], taken, unique=True).collect()] == [1]
    twice = lookup.composite_join(df, dim.union(dim), ["x", "y"], taken, unique=True)
    with pytest.raises(Exception, match="repeated keys"):
        twice.collect()


def test_scalar_and_template(spark):
    dim = spark.createDataFrame([(2, "b"), (1, "a")], "id int, v string")
    df = spark.range(2)
    assert {r.v for r in df.withColumn("v", lookup.first_value(dim, F.col("id") > 0, "v", "id")).collect()} == {"a"}
    assert {r.v for r in df.withColumn("v", lookup.first_value(dim, F.col("id") > 5, "v", "id")).collect()} == {None}
    got = lookup.with_template(df, dim.withColumnRenamed("id", "n"), ["v", "n"], "n")
    assert rows(got) == [(0, "a", 1), (1, "a", 1)]
    with pytest.raises(PySparkException):
        lookup.with_template(df, dim.filter("id > 5").withColumnRenamed("id", "n"), ["v"], "n").collect()
    with pytest.raises(PySparkException):
        lookup.require_value(df, "v", lookup.first_value(dim, F.col("id") > 5, "v", "id"), "none").collect()


def test_existence(spark, facts, dim):
    known = {"hot", "0", "1"}
    expected = sum(1 for r in facts.collect() if r.k in known)
    assert lookup.exists_in(facts, dim, "k", "key").count() == expected
    assert lookup.missing_from(facts, dim, "k", "key").count() == facts.count() - expected


def test_member_flag(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "g string")
    listed = spark.createDataFrame([("b",), ("b",), (None,)], "n string")
    assert {r.g: r.f for r in lookup.flag_member(df, "g", listed, "n", ["a"], "f").collect()} == {
        "a": True,
        "b": True,
        "c": False,
        None: None,
    }
    assert {r.f for r in lookup.flag_member(df, "g", listed.limit(0), "n", [], "f").collect()} == {False, None}


def test_hot_keys_are_spread_by_their_size(spark, facts):
    assert [tuple(r) for r in lookup.hot_keys(facts, "k", 50).collect()] == [("hot", 4)]
    assert [r[0] for r in lookup.hot_keys(facts, "k", 1, most=1).collect()] == ["hot"]
    assert lookup.hot_keys(facts, "k").count() == 0


# -- audits -----------------------------------------------------------------------------


def test_rates_on_empty_tables(spark):
    empty = spark.createDataFrame([], "id int, v string")
    assert tuple(audit.match_rate(empty, "v").first()) == (0, 0, 0.0)
    assert tuple(audit.retention(empty, empty).first()) == (0, 0, 0, 0.0)
    assert tuple(audit.duplicate_counts(empty, ["id"]).first()) == (0, 0, 0)


def test_counts(spark):
    df = spark.createDataFrame([("x", None), ("x", "b"), (None, "b"), (None, None)], "a string, b string")
    assert tuple(audit.duplicate_counts(df, ["a"]).first()) == (4, 2, 2)
    assert audit.match_counts(df, "a").first().asDict() == {"total": 4, "a_matched": 2, "a_unmatched": 2}
    assert tuple(audit.precedence_counts(df, "a", "b").first()) == (2, 1, 1)
    assert [tuple(r) for r in audit.frequency(df, "a").collect()] == [(None, 2), ("x", 2)]
    assert tuple(audit.match_rate(df, "a").first()) == (4, 2, 50.0)


def test_funnel_balances(spark):
    df = spark.range(100)
    steps = [("even", "r1", F.col("id") % 2 == 0), ("small", "r2", F.col("id") < 30), ("none", "r3", F.lit(None).cast("boolean"))]
    got = audit.step_funnel(df, steps).collect()
    assert [(r.step_no, r.records_before, r.records_after, r.records_removed) for r in got] == [
        (1, 100, 50, 50),
        (2, 50, 15, 35),
        (3, 15, 0, 15),
    ]


def test_distribution_shares(spark):
    df = spark.createDataFrame([(0, "a"), (0, None), (1, None)], "p int, s string")
    got = {(r["measure"], r["value"]): (r["count"], r["percentage"]) for r in audit.distribution(df, ["p", "s"]).collect()}
    assert got == {("p", "0"): (2, 66.67), ("p", "1"): (1, 33.33), ("s", "a"): (1, 33.33), ("s", None): (2, 66.67)}
