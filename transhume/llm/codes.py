"""Product codes of vectors, fitted and assigned through dictionaries of the values in each dimension."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transhume.session import stage

#: Parts of a vector, entries of a part's codebook, rounds of fitting, and steps of a unit.
PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096

#: Components of the vectors that share their dictionaries.
BLOCK = 1 << 20


class CodesError(ValueError):
    """A component is too large for whole distances."""


def kept(vector: Column) -> Column:
    """True for vectors that are not null and hold neither null nor non-finite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector.cast("array<double>"), bad)


def dictionaries(rows: DataFrame, length: int, scale: int) -> DataFrame:
    """Blocks of rows ``row vector``, stored once: ``rows values codes``.

    A block holds, for each dimension, its distinct integers (``values``) and the place of
    each vector's integer among them (``codes``). Nothing that grows with the table is held
    together: a block's dictionaries have at most as many values as the block has vectors.
    """
    many = max(1, BLOCK // max(length, 1))
    # Squares of differences, summed over a vector, stay below 2^63.
    limit = int((2**61 / max(length, 1)) ** 0.5)
    row = rows.schema["row"].dataType
    schema = T.StructType(
        [
            T.StructField("rows", T.ArrayType(row)),
            T.StructField("values", T.ArrayType(T.BinaryType())),
            T.StructField("codes", T.ArrayType(T.BinaryType())),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, many):
                b = whole.slice(at, many)
                numbers = np.floor(scale * _matrix(b.column("vector"), length))
                if np.abs(numbers).max(initial=0) > limit:
                    raise CodesError(f"a component is beyond ±{limit / scale:.0f}: distances would not fit 64 bits")
                values, codes = [], []
                for column in numbers.astype(np.int64).T:
                    own, place = np.unique(column, return_inverse=True)
                    values.append(own.astype("<i8").tobytes())
                    codes.append(place.astype("<u4" if len(own) > 1 << 16 else "<u2").tobytes())
                held = pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column("row"))
                kinds = pa.list_(pa.binary())
                yield pa.RecordBatch.from_arrays([held, pa.array([values], kinds), pa.array([codes], kinds)], names=schema.names)

    return stage(rows.mapInArrow(cut, schema), "codes_blocks")


def _matrix(vectors: pa.Array, length: int) -> np.ndarray:
    """Vectors as rows; a shorter one is filled with zeros."""
    out = np.zeros((len(vectors), length))
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    out[np.arange(length) < sizes[:, None]] = flat
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array | None, list[np.ndarray], list[np.ndarray]]]:
    for b in batches:
        for i in range(b.num_rows):
            values = [np.frombuffer(v, "<i8") for v in b.column("values")[i].as_py()]
            codes = b.column("codes")[i].as_py()
            n = len(b.column("rows")[i].values) if "rows" in b.schema.names else None
            places = [np.frombuffer(c, "<u4" if len(v) > 1 << 16 else "<u2") for v, c in zip(values, codes, strict=True)]
            yield (b.column("rows")[i].values if n is not None else None), values, places


def nearest(book: np.ndarray, values: list[np.ndarray], codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of one part's codebook, and its squared distance, for every vector of a block.

    The squared differences of every distinct integer to all entries are tabulated once; a
    distance is then a sum of entries of these tables. Ties go to the lower index.
    """
    total = np.zeros((len(codes[0]), len(book)), np.int64)
    for d, (own, place) in enumerate(zip(values, codes, strict=True)):
        table = (own[:, None] - book[None, :, d]) ** 2
        total += table[place]
    best = total.argmin(axis=1)
    return best, total[np.arange(len(best)), best]


def _sums(books: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a task adds to the entries: ``part entry position total many``."""
    parts, entries, width = books.shape
    total, many = np.zeros_like(books), np.zeros((parts, entries), np.int64)
    for _, values, codes in _blocks(batches):
        for p in range(parts):
            mine = slice(p * width, (p + 1) * width)
            best, _ = nearest(books[p], values[mine], codes[mine])
            many[p] += np.bincount(best, minlength=entries)
            for d, (own, place) in enumerate(zip(values[mine], codes[mine], strict=True)):
                counts = np.bincount(best * len(own) + place, minlength=entries * len(own))
                total[p, :, d] += counts.reshape(entries, len(own)) @ own
    part, entry, position = (i.ravel() for i in np.indices(books.shape))
    columns = [part, entry, position, total.ravel(), np.repeat(many.ravel(), width)]
    names = ["part", "entry", "position", "total", "many"]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _assigned(books: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, _, width = books.shape
    digits = np.array([f"{e:02x}" for e in range(books.shape[1])])
    for rows, values, codes in _blocks(batches):
        code, error = np.full(len(rows), "", f"U{2 * parts}"), np.zeros(len(rows), np.int64)
        for p in range(parts if width else 0):
            mine = slice(p * width, (p + 1) * width)
            best, distance = nearest(books[p], values[mine], codes[mine])
            code = np.char.add(code, digits[best])
            error += distance
        if not width:
            code[:] = "00" * parts
        yield pa.RecordBatch.from_arrays([rows, pa.array(code.tolist(), pa.string()), pa.array(error)], names=["row", "code", "error"])


def _first_vectors(vectors: DataFrame, entries: int) -> list[list[float]]:
    """Vectors of the smallest ids, ascending; of an id with several, the smallest vector."""
    ids = vectors.select("id").distinct().orderBy(F.asc_nulls_last("id")).limit(entries).collect()
    if not ids:
        return []
    known = [r.id for r in ids if r.id is not None]
    chosen = F.col("id").isin(known) if known else F.lit(False)
    if len(known) < len(ids):
        chosen |= F.col("id").isNull()
    first = vectors.where(chosen).groupBy("id").agg(F.min("vector").alias("vector"))
    return [r.vector for r in first.orderBy(F.asc_nulls_last("id")).collect()]


def codes_digest(books: np.ndarray) -> str:
    """SHA-256 of all components, by part, entry and position, with commas between."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    keep: list[str] | None = None,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """Codes of all vectors, and the codebooks (part, entry, position).

    The rows have the columns of ``keep`` (all without it), then ``code`` (an entry of each
    part, two hex digits each) and ``error`` (squared distances in steps, summed over the parts);
    input columns of these names give way. Components become ``floor(scale * x)``. Rows whose
    vector is null or holds a null or non-finite component are left out. Rows that repeat are
    coded, and weigh in the codebooks, as often as they occur. A codebook starts from the vectors of
    the ``entries`` smallest ids (null ids last, of an id with several vectors the smallest one) and is
    shorter if there are fewer ids. Vectors that are shorter than the longest, or whose length
    is no multiple of ``parts``, are filled with zeros at the end. An empty table has no codes
    and codebooks without entries. Components that would take a distance beyond 64 bits raise
    ``CodesError``.

    Blocks of vectors are stored once with a dictionary of the integers of each dimension.
    Every round reads these, looks squared differences up, and adds up per task; what reaches
    the driver is one total for each component of the codebooks.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries is from 1 to 256, two hex digits")
    keep = [c for c in (keep or vectors.columns) if c not in ("code", "error")]
    good = vectors.where(kept(F.col(vector_col)))
    slim = good.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    longest = slim.agg(F.max(F.size("vector")).alias("n")).first().n or 0
    width = -(-longest // parts)
    row = F.struct(*[F.col("`" + c.replace("`", "``") + "`").alias(c) for c in keep]).alias("row")
    blocks = dictionaries(good.select(row, F.col(vector_col).cast("array<double>").alias("vector")), parts * width, scale)
    first = [v + [0.0] * (parts * width - len(v)) for v in _first_vectors(slim, entries)]
    starts = np.floor(scale * np.array(first, float)).astype(np.int64).reshape(len(first), parts, width)
    books = starts.transpose(1, 0, 2).copy()
    for _ in range(rounds if books.size else 0):
        books = _next_books(blocks, books)
    schema = T.StructType(
        [T.StructField("row", blocks.schema["rows"].dataType.elementType), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    )
    coded = blocks.mapInArrow(partial(_assigned, books), schema)
    return coded.select(*[F.col("row").getField(c).alias(c) for c in keep], "code", "error"), books


def _next_books(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry replaced by the mean of its parts, rounded down; unused entries stay."""
    per_task = blocks.select("values", "codes").mapInArrow(partial(_sums, books), "part long, entry long, position long, total long, many long")
    out = books.copy()
    for r in per_task.groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("many").alias("many")).collect():
        if r.many:
            out[r.part, r.entry, r.position] = r.total // r.many
    return out


def with_sum_of_equals(rows: DataFrame, key: str, value: str, result: str) -> DataFrame:
    """Add the sum of ``value`` over the rows of an equal key; nulls are equal to each other.

    Rows are stored before the sums are joined to them, so a frequent key is a small partial
    sum first and then either broadcast or split at run time.
    """
    stored = stage(rows, "codes_rows")
    sums = stored.groupBy(F.col(key).alias("_equal")).agg(F.sum(value).alias(result))
    return stored.drop(result).join(sums, F.col(key).eqNullSafe(F.col("_equal"))).drop("_equal")
