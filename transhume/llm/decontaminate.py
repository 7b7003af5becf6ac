"""Test items in training documents, by a broadcast set of word windows."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transhume.session import stage

WINDOW = 10

#: Blocks that are looked for in one stage; each is a Python worker of a task.
TOGETHER = 2

#: Words of items in one broadcast block; a larger benchmark is looked for block after block.
BLOCK_WORDS = 1_000_000

#: Lower case for A-Z; a space for every ASCII character that is neither letter nor digit.
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def item_words(text: str | None) -> list[bytes]:
    """Runs of letters, digits and non-ASCII characters, A-Z in lower case."""
    return text.encode().translate(_TABLE).split() if text else []


class Block:
    """Windows of some items: a vocabulary, and for each length sorted hashes with their windows."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in item_words(text)]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1 if ids else 0):
                windows.setdefault(size, {}).setdefault(tuple(ids[i : i + size]), set()).add(item)
        self.lengths = {}
        for size, found in windows.items():
            grams = np.array(list(found), np.uint64).reshape(-1, size)
            hashes = self.hashes(grams.T)
            order = np.argsort(hashes)
            self.lengths[size] = (hashes[order], {g: sorted(found[g]) for g in found})

    @staticmethod
    def hashes(columns) -> np.ndarray:
        total = np.uint64(0)
        for c in columns:
            total = (total ^ c) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
        return total

    def scan(self, tokens: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie in an occurrence of a window, and the items that occur."""
        hit, items = np.zeros(len(tokens), bool), set()
        ids = np.fromiter(map(self.vocabulary.get, tokens, repeat(0)), np.uint64, len(tokens))
        unknown = np.concatenate([[0], np.cumsum(ids == 0)])
        for size, (hashes, windows) in self.lengths.items():
            starts = np.flatnonzero(unknown[size:] == unknown[:-size])
            if not len(starts):
                continue
            own = self.hashes(ids[starts + k] for k in range(size))
            place = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
            for s in starts[hashes[place] == own].tolist():
                named = windows.get(tuple(ids[s : s + size].tolist()))
                if named is not None:  # an equal hash is not yet an equal window
                    hit[s : s + size] = True
                    items.update(named)
        return hit, items


def blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_words: int) -> Iterator[Block]:
    """The benchmark in blocks of bounded size, read one after the other."""
    rows = benchmark.select(F.col(item_col).cast("string"), F.col(text_col))
    held, size = [], 0
    for item, text in rows.toLocalIterator():
        held.append((item or "", text))
        size += len(item_words(text))
        if size >= block_words:
            yield Block(held, window)
            held, size = [], 0
    if held:
        yield Block(held, window)


_COUNT, _ITEMS = T.StructField("n_words", T.LongType()), T.StructField("items", T.ArrayType(T.StringType()))
_STATE = [_COUNT, T.StructField("hit", T.BinaryType()), _ITEMS]


def _scan(block: Broadcast, first: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The block's hits, added to those of the blocks before."""
    for b in batches:
        counts, masks, named = [], [], []
        for i, text in enumerate(b.column("_text")):
            tokens = item_words(text.as_py())
            hit, items = block.value.scan(tokens)
            if not first:
                before = np.unpackbits(np.frombuffer(b.column("hit")[i].as_py(), np.uint8), count=len(tokens))
                hit |= before.astype(bool)
                items.update(b.column("items")[i].as_py())
            counts.append(len(tokens))
            masks.append(np.packbits(hit).tobytes())
            named.append(sorted(items))
        yield pa.RecordBatch.from_arrays(
            [b.column("_row"), b.column("_text"), pa.array(counts, pa.int64()), pa.array(masks, pa.binary()), pa.array(named, pa.list_(pa.string()))],
            names=["_row", "_text", "n_words", "hit", "items"],
        )


def _report(block: Broadcast, first: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last block, and what all blocks have found."""
    for b in _scan(block, first, batches):
        hits = [int(np.bitwise_count(np.frombuffer(m.as_py(), np.uint8)).sum()) for m in b.column("hit")]
        clean = [_without(t.as_py(), m.as_py()) if n else t.as_py() for t, m, n in zip(b.column("_text"), b.column("hit"), hits, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [b.column("_row"), pa.array(clean, b.column("_text").type), b.column("n_words"), pa.array(hits, pa.int64()), b.column("items")],
            names=["_row", "clean", "n_words", "n_hit", "items"],
        )


def _without(text: str, mask: bytes) -> str:
    """The text without the spans of its hit words; one line break stands for each span."""
    data = text.encode()
    plain = np.frombuffer(data.translate(_TABLE), np.uint8) != 0x20
    edge = np.diff(np.concatenate([[0], plain.astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    hit = np.unpackbits(np.frombuffer(mask, np.uint8), count=len(starts)).astype(np.int8)
    span = np.diff(np.concatenate([[0], hit, [0]]))
    out, at = [], 0
    for a, z in zip(np.flatnonzero(span == 1).tolist(), np.flatnonzero(span == -1).tolist(), strict=True):
        out += [data[at : starts[a]], b"\n"]
        at = int(ends[z - 1])
    return b"".join([*out, data[at:]]).decode()


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    keep: list[str] | None = None,
) -> DataFrame:
    """Every document with what it holds of the benchmark.

    Returns ``_row`` (struct of all columns or those of ``keep``, whatever their names), ``clean`` (the text
    without the hit spans), ``n_words``, ``n_hit`` (words inside an occurrence of a window)
    and ``items`` (sorted ids, as text, of items with an occurring window). A window is
    ``window`` consecutive words of an item, or the whole item if it has fewer words; items
    without words have none. Null and empty texts have no words and no hits. A null item id
    is named by the empty text; items that repeat count once by id. An empty benchmark hits
    nothing.

    The windows are broadcast in blocks of ``block_words`` words, a fixed bound, of which ``TOGETHER`` are
    held at a time. A larger benchmark makes a chain of passes over the same partitions without a shuffle; after
    each pass but the last the documents and their hits so far are stored, and its blocks are let go.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("_row"), F.col(text_col).alias("_text"))
    kinds = T.StructType([*rows.schema, *_STATE])
    context = docs.sparkSession.sparkContext
    source = blocks(benchmark, item_col, item_text_col, window, block_words)
    group, first = list(islice(source, TOGETHER)) or [Block([], window)], True
    while True:
        held = [context.broadcast(b) for b in group]
        group = list(islice(source, TOGETHER))
        for block in held if group else held[:-1]:
            rows = rows.mapInArrow(partial(_scan, block, first), kinds)
            first = False
        if not group:
            break
        rows = stage(rows, "decontaminate")
        for block in held:
            block.destroy()
    made = [rows.schema["_row"], T.StructField("clean", T.StringType()), _COUNT, T.StructField("n_hit", T.LongType()), _ITEMS]
    return rows.mapInArrow(partial(_report, held[-1], first), T.StructType(made))


def decontaminate(docs: DataFrame, benchmark: DataFrame, action: str = "documents", text_col: str = "text", **how) -> DataFrame:
    """Documents without test items; all columns stay.

    ``action`` is ``documents`` (a document with a hit goes) or ``spans`` (only the hit
    words go from its text). See ``find_items``.
    """
    found = find_items(docs, benchmark, text_col, **how)
    if action == "documents":
        return found.where("n_hit = 0").select("_row.*")
    if action != "spans":
        raise ValueError(f"action is documents or spans, not {action!r}")
    return found.select(*[F.col("clean" if c == text_col else f"_row.`{c}`").alias(c) for c in docs.columns])
