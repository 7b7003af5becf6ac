"""Repair of conversations against a search of all edits, row by row."""

import hashlib
import itertools
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from transhume.llm import repair
from transhume.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
ROWS = "conv_id long, turn long, role string, text string, place string, order int"


def best_edits(rows):
    """(cost, initials) of rows (initial, truncated, gone): every order of edits, without tables."""
    n = len(rows)

    @lru_cache(None)
    def ahead(i, state, inserted=0):
        wanted = "a" if state == "u" else "u"
        found = []
        if i == n and state in ("", "a"):
            found.append((0, ""))
        if inserted < 2:
            cost, rest = ahead(i, wanted, inserted + 1)
            found.append((cost + 3, "I" + rest))
        if i < n:
            initial, truncated, gone = rows[i]
            cost, rest = ahead(i + 1, state)
            found.append((cost + 4, "D" + rest))
            if not gone:
                more = 3 * truncated
                if initial == wanted or (initial == "s" and state == ""):
                    cost, rest = ahead(i + 1, initial)
                    found.append((cost + more, "K" + rest))
                cost, rest = ahead(i + 1, wanted)
                found.append((cost + 3 + more, "R" + rest))
        return min(found) if found else (10**9, "")

    for i in range(n, 0, -50):  # from the end, so that the search does not nest deeply
        for state in ("", "s", "u", "a"):
            ahead(i, state)
    return ahead(0, "")


KINDS = [(i, t, False) for i in "suao" for t in (False, True)] + [("u", False, True)]


def classes(rows):
    return np.array([8 if gone else "suao".index(i) + 4 * t for i, t, gone in rows], int)


def test_tables_find_the_cheapest_edits_and_the_least_initials():
    for n in range(5):
        for rows in itertools.product(KINDS, repeat=n):
            assert repair.tables().cheapest(classes(rows)) == best_edits(rows), rows
    rng = np.random.default_rng(3)
    for _ in range(300):
        rows = tuple(KINDS[k] for k in rng.integers(0, len(KINDS), rng.integers(5, 40)))
        assert repair.tables().cheapest(classes(rows)) == best_edits(rows), rows


def test_few_cost_vectors_occur():
    assert len(repair.tables().vectors) < 60


def order_of(row):
    conv, turn, role, text = row
    return (turn is not None, turn or 0, role, text[:64], hashlib.md5(text.encode()).hexdigest())


def expected(original):
    """The contract, in plain Python: conv_id to its columns."""
    after = {}
    for conv, turn, role, text in original:
        mine = after.setdefault(conv, [])
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        mine += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv, rows in after.items():
        rows.sort(key=order_of)
        seen, kinds, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in rows:
            bare = text.strip(" \t\n\x0b\f\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                count[fault] += 1
            kinds.append((role[:1] if role[:1] in ("s", "u", "a") else "o", fault == "truncated", fault in ("blank", "duplicate")))
        turns = [t for _, t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:], strict=False))
        cost, audit = best_edits(tuple(kinds))
        said, at, state = [], 0, ""
        for e in audit:
            wanted = "a" if state == "u" else "u"
            name = {"a": "assistant", "u": "user"}[wanted]
            if e == "I":
                said.append(f"{name}:")
                state = wanted
                continue
            _, _, role, text = rows[at]
            at += 1
            if e != "D":
                said.append(f"{role if e == 'K' else name}:{text}")
                state = role[0] if e == "K" else wanted
        assert re.fullmatch("(s?(ua)+)?", "".join(s[0] for s in said))
        digest = hashlib.sha256("\n".join(said).encode()).hexdigest()
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest)
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def query_on(spark, tmp_path, rows, schema=ROWS):
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got}


def test_query_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op11_conversation_repair"](spark, SF_DIR).collect()
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got} == expected(rows)


def test_query_on_odd_conversations(spark, tmp_path):
    rng = np.random.default_rng(1)
    roles, texts = ["system", "user", "assistant", "tool", None, ""], ["Yes.", "no", "", " \n", None, "So?  ", "é!", "ok. x" * 2000]
    rows = []
    for conv in [*range(60), None]:
        for turn in rng.integers(0, 12, rng.integers(0, 14)).tolist():
            rows.append((conv, None if turn == 11 else turn, roles[rng.integers(6)], texts[rng.integers(8)]))
    rows += rows[:40]
    # One conversation holds a third of the rows, and one text a third of these.
    rows += [(1000, t, "user" if t % 2 == 0 else "assistant", "the same." if t % 3 == 0 else f"{t}.") for t in range(400)]
    assert query_on(spark, tmp_path, [(*r, "p", 5) for r in rows]) == expected(rows)


def test_nothing_is_left(spark, tmp_path):
    gone = next(t for t in range(100) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert query_on(spark, tmp_path / "a", [(5, gone, "user", "a.", "", 0)]) == {5: (0, 0, 0, 0, 0, 0, "", empty)}
    assert query_on(spark, tmp_path / "b", []) == {}


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "What"), (1, 2, "tool", "x."), (2, 0, "user", " ")]
    found = repair.repair(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"))
    plans = {r.conv_id: r.audit for r in found.plans.collect()}
    assert plans[2] == "D" and set(plans) == {1, 2}
    got = [tuple(r) for r in found.rows.orderBy("conv_id", "place").collect()]
    kept = [r for r in got if r[2] != "I"]
    assert [r[1] for r in got] == list(range(len(got))) and all(r[3] is None and r[5] == "" for r in got if r[2] == "I")
    assert {r[5] for r in kept} <= {"Hi.", "What", "x."} and plans[1].count("D") == 3 - len(kept)


def test_a_long_conversation_is_dealt_out(spark):
    many = spark.range(40_000).select(
        F.lit(7).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("turn "), F.col("id"), F.lit(".")).alias("text"),
    )
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        found = repair.repair(many)
        assert found.rows.count() == 40_000 and found.plans.first().cost == 0
        stored = spark.read.parquet(found.plans.inputFiles()[0].rsplit("/", 1)[0]).first()
        assert len(stored.starts) > 1 and sum(s.n for s in stored.starts) == 40_000
    finally:
        spark.conf.unset(key)


@pytest.mark.parametrize("n", [0, 1, 7])
def test_digests_of_streams(spark, n):
    rows = [(c, i, "user", f"{c} {i}") for c in (None, 1, 2) for i in range(n)]
    got = dict(repair.digests(spark.createDataFrame(rows, "conv_id long, place long, role string, text string").repartition(2)).collect())
    want = {c: "\n".join(f"user:{c} {i}" for i in range(n)) for c in (None, 1, 2) if n}
    assert got == {c: hashlib.sha256(t.encode()).hexdigest() for c, t in want.items()}
