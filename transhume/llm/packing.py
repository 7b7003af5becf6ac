"""Token sequences of fixed length with little padding, as a cutting-stock problem."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transhume.llm.ranking import numbered
from transhume.llm.text import batch

#: Tokens of a sequence.
CAPACITY = 4096

#: Tokens of a unit of length: pieces are binned by length in units, rounded up.
UNIT = 8

#: Column generation ends within this share of the lower bound of the linear program.
GAP = 0.0005

#: Pieces of the scaled histogram whose filling gives the first patterns.
POOL = 20_000

#: Words whose ids a task remembers.
REMEMBERED = 200_000


# --- cutting stock ----------------------------------------------------------------


@dataclass(frozen=True)
class Plan:
    """How many sequences follow each pattern, and how many pieces of each class a pattern holds.

    ``copies[p]`` sequences follow pattern p; the numbers of its sequences begin at
    ``first[p]``. The entries of class c are those from ``start[c]`` to ``start[c + 1]``: ``pattern``,
    ``many`` (pieces of the class in a sequence of it) and ``upto`` (ranks of the class that are
    placed after the entry).
    """

    copies: np.ndarray
    first: np.ndarray
    start: np.ndarray
    pattern: np.ndarray
    many: np.ndarray
    upto: np.ndarray

    def sequences(self, classes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """Number of the sequence of the piece with that rank among the pieces of its class."""
        out = np.zeros(len(classes), np.int64)
        for c in np.unique(classes):
            mine = classes == c
            a, b = self.start[c], self.start[c + 1]
            entry = a + np.searchsorted(self.upto[a:b], ranks[mine], side="right")
            before = np.where(entry > a, self.upto[np.maximum(entry - 1, 0)], 0)
            out[mine] = self.first[self.pattern[entry]] + (ranks[mine] - before) // self.many[entry]
        return out


def best_pattern(prices: np.ndarray, room: int) -> np.ndarray:
    """Pieces per class that fit the room and are worth most, by dynamic programming. Class c has length c."""
    top = len(prices) - 1
    worth, taken = np.zeros(room + 1), np.zeros(room + 1, np.int64)
    for w in range(1, room + 1):
        n = min(w, top)
        value = worth[w - n : w][::-1] + prices[1 : n + 1]  # class 1, 2, … first
        c = int(value.argmax())
        if value[c] > worth[w - 1]:
            worth[w], taken[w] = value[c], c + 1
        else:
            worth[w] = worth[w - 1]
    pattern, w = np.zeros(top + 1, np.int64), room
    while w > 0:
        if taken[w]:
            pattern[taken[w]] += 1
            w -= taken[w]
        else:
            w -= 1
    return pattern


def solve(demand: np.ndarray, room: int, gap: float = GAP, most: int = 4000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (a row each) and how often each is used in the linear program.

    Column generation with a revised simplex method: the dual prices of the classes go to
    the knapsack, the pattern that is worth most enters the basis. Ends at the optimum, or
    once the best price proves the value to be within ``gap`` of it. Patterns of a filling
    of the histogram, scaled to ``POOL`` pieces, are tried before the knapsack is asked.
    """
    scaled = np.ceil(demand * min(1.0, POOL / demand.sum())).astype(np.int64)
    pool = np.unique(np.array(fill(scaled, room)), axis=0).astype(float)
    classes = np.flatnonzero(demand)
    m = len(classes)
    basis = np.zeros((m, len(demand)), np.int64)
    basis[np.arange(m), classes] = room // classes
    inverse = np.diag(1.0 / (room // classes))
    used = demand[classes] / (room // classes)
    for _ in range(most):
        prices = np.zeros(len(demand))
        prices[classes] = inverse.sum(axis=0)
        worth = pool @ prices
        pattern = pool[worth.argmax()].astype(np.int64)
        value = float(worth.max())
        if value <= 1 + gap:
            pattern = best_pattern(np.maximum(prices, 0), room)
            value = float(prices @ pattern)
        if value <= 1 + gap:
            break
        column = inverse @ pattern[classes]
        ratio = np.where(column > 1e-9, used / np.where(column > 1e-9, column, 1), np.inf)
        leave = int(ratio.argmin())
        step = ratio[leave]
        if not np.isfinite(step):
            break
        used = np.maximum(used - step * column, 0)
        used[leave] = step
        basis[leave] = pattern
        pivot = inverse[leave] / column[leave]
        inverse -= np.outer(column, pivot)
        inverse[leave] = pivot
    return basis, used


def fill(rest: np.ndarray, room: int) -> list[np.ndarray]:
    """Sequences for the few pieces that whole patterns leave over: the largest that fits, until none does."""
    out, rest = [], rest.copy()
    while rest.any():
        pattern, left = np.zeros_like(rest), room
        while left > 0 and (fits := np.flatnonzero(rest[: left + 1])).size:
            c = int(fits[-1])
            n = min(int(rest[c]), left // c)
            pattern[c] += n
            rest[c] -= n
            left -= n * c
        out.append(pattern)
    return out


def plan_of(demand: np.ndarray, room: int) -> Plan:
    """Patterns for a histogram of classes: rounded down, then what is left over is filled."""
    rows, copies = [], []
    rest = demand.astype(np.int64).copy()
    if rest.any():
        basis, used = solve(demand.astype(float), room)
        for pattern, x in sorted(zip(map(tuple, basis), used, strict=True), reverse=True):
            pattern = np.array(pattern)
            has = pattern > 0
            n = min(int(np.floor(x + 1e-6)), int((rest[has] // pattern[has]).min())) if has.any() else 0
            if n:
                rest -= n * pattern
                rows.append(pattern)
                copies.append(n)
    for pattern in fill(rest, room):
        rows.append(pattern)
        copies.append(1)
    table = np.array(rows, np.int64).reshape(len(rows), len(demand))
    many_copies = np.array(copies, np.int64)
    start, pattern, many, upto = [0], [], [], []
    for c in range(len(demand)):
        own = np.flatnonzero(table[:, c])
        pattern.append(own)
        many.append(table[own, c])
        upto.append(np.cumsum(table[own, c] * many_copies[own]))
        start.append(start[-1] + len(own))
    join = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
    return Plan(many_copies, np.cumsum(many_copies) - many_copies, np.array(start), join(pattern), join(many), join(upto))


# --- tokens -----------------------------------------------------------------------


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: The vocabulary's own pattern for words, for texts of ASCII and Latin-1 in lower case.
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^\sa-zªµºß-öø-ÿ0-9²³¹¼-¾]+")

#: Any other character: such a text goes to the tokenizer whole.
_FOREIGN = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\xff]")


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write a byte: itself if it is visible, else one from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = (b for b in range(256) if b not in visible)
    return {b: chr(b) for b in visible} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


_LETTERS = _byte_letters()


class Encoder(dict):
    """Ids of whole texts as little-endian 32-bit numbers.

    The tokenizer lower-cases a text, cuts it into words and merges each alone, so the ids of
    a text are those of its words; those of a word are kept while there is room.
    """

    def __init__(self, path: str, end: int):
        super().__init__()
        self.tokenizer, self.end = _tokenizer(path), np.array([end], "<u4").tobytes()
        self.merge = self.tokenizer.model.tokenize

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        letters = word if word.isascii() else word.encode().decode("latin-1").translate(_LETTERS)
        self[word] = ids = np.array([t.id for t in self.merge(letters)], "<u4").tobytes()
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return self.end
        if _FOREIGN.search(text) or "<|" in text:  # "<|" may begin a special token
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        else:
            ids = b"".join(map(self.__getitem__, _WORDS.findall(text.lower())))
        return ids + self.end


@lru_cache(maxsize=2)
def _encoder(path: str, end: int) -> Encoder:
    """One per worker process: what a task has learned serves the next."""
    return Encoder(path, end)


def _pieces(path: str, end: int, capacity: int, unit: int, ids: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = [("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("class", pa.int32()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + ([("ids", pa.binary())] if ids else []))
    for b in batches:
        rows, own = [], []
        for i, data in enumerate(_encoder(path, end).encode(t.as_py()) for t in b.column("text")):
            n = len(data) // 4
            for start in range(0, n, capacity):
                part = data[4 * start : 4 * (start + capacity)]
                length = len(part) // 4
                row = (start, length, n, -(-length // unit), zlib.crc32(part))
                rows.append((*row, part) if ids else row)
                own.append(i)
        made = batch(schema, *(zip(*rows, strict=True) if rows else [[]] * len(schema)))
        yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(own, pa.int64())), *made.columns], names=["doc_id", *schema.names])


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end: int = 2,
    capacity: int = CAPACITY,
    unit: int = UNIT,
    ids: bool = False,
) -> DataFrame:
    """Pieces of all documents with their place in sequences of ``capacity`` tokens.

    Returns ``doc_id start length doc_tokens ids_crc32 sequence_id offset`` (and ``ids``, 32-bit
    little-endian, if asked for). A document's ids are those of its whole text and ``end``; a null
    or empty text has the end alone. Longer documents are cut at multiples of ``capacity``. Within
    a sequence pieces lie one after the other from offset 0. Rows that repeat are packed as
    often as they occur; an empty table gives no piece.

    Lengths are binned in ``unit`` tokens. The histogram (``capacity / unit`` classes, whatever
    the table) goes to the driver, where column generation finds patterns; these, at most a
    few per class, are broadcast. Pieces are ranked within their class by task, so that a
    frequent length is not one task's.
    """
    if capacity % unit:
        raise ValueError("capacity is a multiple of unit")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    made = [rows.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in ("start", "length", "doc_tokens"))]
    made += [T.StructField("class", T.IntegerType()), T.StructField("ids_crc32", T.LongType())]
    made += [T.StructField("ids", T.BinaryType())] if ids else []
    cut = partial(_pieces, tokenizer, end, capacity, unit, ids)
    ranked = numbered(rows, ["class"], "_rank", "pieces", cut, T.StructType(made))
    room = capacity // unit
    demand = np.zeros(room + 1, np.int64)
    for r in ranked.groupBy("class").agg(F.count("*").alias("n")).collect():
        demand[r["class"]] = r.n
    held = docs.sparkSession.sparkContext.broadcast(plan_of(demand, room))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = held.value.sequences(b.column("class").to_numpy(), b.column("_rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at)], names=[*b.schema.names, "sequence_id"])

    placed = ranked.mapInArrow(assign, T.StructType([*ranked.schema, T.StructField("sequence_id", T.LongType())]))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "_rank").rowsBetween(Window.unboundedPreceding, -1)
    names = ["doc_id", "start", "length", "doc_tokens", "ids_crc32", "sequence_id"]
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")
    return placed.select(*names, offset, *(["ids"] if ids else []))
