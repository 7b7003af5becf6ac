"""Words, hashes and batches shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space between words, as a pattern of Spark SQL.
SPACE = r"[\x20\x09-\x0D]+"

SEED = 42


def words_of(text: Column) -> Column:
    """Words between ASCII white space; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def digest_of(text: Column) -> Column:
    """128-bit digest of a text; null counts as the empty text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def split_of(doc_id: Column) -> Column:
    """Quarter of a document: ``crc32(doc_id as text) mod 4``; a null id belongs to quarter 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4, F.lit(0))


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case."""
    return text.encode().lower().split() if text else []


def shingle_hashes(tokens: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words, repeats included; a shorter text is one run."""
    if not tokens:
        return np.zeros(0, np.uint64)
    size = min(size, len(tokens))
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(tokens) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    spans = zip(starts, ends[size - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(starts))


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that each hold whole runs of equal keys of a sorted stream, many runs at a time."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        if held and any(held[-1].column(k)[-1].as_py() != b.column(k)[0].as_py() for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        start = run_starts(b, keys)[-1]
        if start:
            yield pa.Table.from_batches([*held, b.slice(0, start)])
            held = []
        held.append(b.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def run_starts(rows: pa.RecordBatch | pa.Table, keys: list[str]) -> np.ndarray:
    """Where runs of equal keys begin; a null is equal to a null."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for k in keys:
        column = rows.column(k)
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        a, b = column[1:], column[:-1]
        same = pc.if_else(pc.and_(a.is_valid(), b.is_valid()), pc.equal(a, b), pc.equal(a.is_valid(), b.is_valid()))
        new[1:] |= ~same.to_numpy(zero_copy_only=False).astype(bool)
    return np.flatnonzero(new)
