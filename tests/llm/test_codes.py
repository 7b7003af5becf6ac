"""Vector codes against whole arrays, by the contract's words."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from transhume.llm import codes
from transhume.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, code string, `a.row` string"


def expected(rows, parts=8, entries=16, rounds=6):
    """Codes and codebooks of (id, vector) with every distance worked out."""
    good = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    longest = max((len(v) for _, v in good), default=0)
    width = -(-longest // parts)
    whole = np.array([v + [0.0] * (parts * width - len(v)) for _, v in good], np.float32).astype(float)
    ints = np.floor(4096 * whole).astype(np.int64).reshape(len(good), parts, width)
    first = {}
    for k, (i, v) in enumerate(good):
        key = (i is None, i or 0)
        if key not in first or v < good[first[key]][1]:
            first[key] = k
    books = ints[[first[k] for k in sorted(first)][:entries]].transpose(1, 0, 2).copy()

    def assign():
        apart = ((ints[:, :, None, :] - books[None]) ** 2).sum(-1)
        return apart.argmin(-1), apart.min(-1).sum(-1)

    for _ in range(rounds):
        near, _ = assign()
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = ints[near[:, p] == e, p]
                if len(mine):
                    books[p, e] = [int(s) // len(mine) for s in mine.sum(0)]
    near, error = assign()
    return sorted((i is None, i or 0, "".join(f"{e:02x}" for e in n), int(d)) for (i, _), n, d in zip(good, near, error, strict=True)), books


def got_of(df):
    return sorted((r.vec_id is None, r.vec_id or 0, r.code, r.error) for r in df.collect())


def vectors(seed, n, length, scale=0.3):
    return np.random.default_rng(seed).normal(0, scale, (n, length)).astype(np.float32).tolist()


@pytest.mark.parametrize(("n", "length"), [(300, 64), (5, 16), (40, 11), (1, 8)])
def test_codes_and_codebooks(spark, n, length):
    rows = list(zip(range(n, 0, -1), vectors(n, n, length), strict=True))
    df = spark.createDataFrame([(i, v, 0, "", "") for i, v in rows], SCHEMA).repartition(3)
    coded, books = codes.compress(df)
    want, want_books = expected(rows)
    assert coded.columns == ["vec_id", "embedding", "label", "a.row", "code", "error"]
    assert (books == want_books).all() and got_of(coded) == want


def test_odd_rows(spark):
    good = vectors(7, 30, 16)
    rows = [(i // 2, v) for i, v in enumerate(good)]  # two vectors an id
    rows += [(90, None), (91, [None] * 16), (92, [float("nan")] * 16), (93, [float("inf")] + [0.0] * 15), (94, [-float("inf")] * 16)]
    rows += [(None, good[0]), (None, good[1]), (95, good[3][:5]), (96, []), (3, good[6]), (3, good[6])]
    df = spark.createDataFrame([(i, v, None, "c", "r") for i, v in rows], SCHEMA)
    coded, books = codes.compress(df, keep=["vec_id"])
    want, want_books = expected(rows)
    assert (books == want_books).all() and got_of(coded) == want


def test_no_vectors(spark):
    for rows in ([], [(1, None, 1, "", "")]):
        coded, books = codes.compress(spark.createDataFrame(rows, SCHEMA))
        assert coded.count() == 0 and books.size == 0
        assert codes.codes_digest(books) == hashlib.sha256(b"").hexdigest()
    coded, _ = codes.compress(spark.createDataFrame([(1, [], 1, "", "")], SCHEMA))
    assert [(r.code, r.error) for r in coded.collect()] == [("00" * 8, 0)]


def test_too_large_components_raise(spark):
    with pytest.raises(Exception, match="CodesError"):
        codes.compress(spark.createDataFrame([(1, [1e30] * 8, 1, "", "")], SCHEMA))


def test_ties_go_to_the_lower_entry():
    book, values = np.array([[0], [4], [4], [2]]), [np.array([1, 2, 3, 4])]
    best, apart = codes.nearest(book, values, [np.array([0, 1, 2, 3], np.uint16)])
    assert best.tolist() == [0, 3, 1, 1] and apart.tolist() == [1, 0, 1, 0]


def test_sums_of_equal_labels(spark):
    rows = [(1, None, 5), (2, None, 6), (3, 1, 7), (4, 1, 0), (5, 2, 1)]
    got = codes.with_sum_of_equals(spark.createDataFrame(rows, "id int, label int, error long"), "label", "error", "total")
    assert sorted((r.id, r.total) for r in got.collect()) == [(1, 11), (2, 11), (3, 7), (4, 7), (5, 1)]


def test_query_on_labels(spark, tmp_path):
    rows = [(i, v, (None, 1, 2)[i % 3], "", "") for i, v in enumerate(vectors(3, 100, 64))]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r.vec_id: r for r in QUERIES["op13_vector_codes"](spark, str(tmp_path)).collect()}
    want, books = expected([(r[0], r[1]) for r in rows])
    by_label = {}
    for _, i, _, error in want:
        by_label[rows[i][2]] = by_label.get(rows[i][2], 0) + error
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    assert {i: (r.code, r.error, r.label_error, r.codebooks_sha256) for i, r in got.items()} == {
        i: (c, e, by_label[rows[i][2]], digest) for _, i, c, e in want
    }


def test_rounds_read_codes_alone(spark):
    df = spark.createDataFrame([(i, v, 0, "", "") for i, v in enumerate(vectors(1, 50, 16))], SCHEMA)
    blocks = codes.dictionaries(df.select(F.struct("vec_id").alias("row"), F.col("embedding").cast("array<double>").alias("vector")), 16, 4096)
    plan = blocks.select("values", "codes")._jdf.queryExecution().executedPlan().toString()
    assert "rows" not in plan.split("ReadSchema")[-1]
