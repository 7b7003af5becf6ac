"""Cheapest repairs of conversations, by lookups in tables of whole blocks of rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from transhume.llm.text import digest_of, run_starts
from transhume.session import stage

#: Costs of the edits, and what a truncated row costs that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: Rows of a block of the tables.
BLOCK = 4

#: Rows whose symbols are gathered as one text before a conversation's are.
GATHERED_BITS = 16

#: Edits that are handed over at a time.
HANDED = 1 << 16

_WHITE = " \t\n\x0b\f\r"

# What a conversation has come to: nothing yet, or a system, user or assistant turn.
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
_ENDS = (0, None, None, 0)

# Classes of rows: an initial (s, u, a, other), whole or truncated; a row that must go; no row.
_GONE, _NO_ROW, _CLASSES = 8, 9, 10


def _wanted(state: int) -> int:
    """The turn that must come next."""
    return _ASSISTANT if state == _USER else _USER


def _kept(state: int, initial: int) -> int | None:
    """What a conversation comes to with one more turn of that initial; None if it may not follow."""
    if initial == 0:
        return _SYSTEM if state == _NOTHING else None
    return initial + 1 if initial < 3 and initial + 1 == _wanted(state) else None


def _with_inserts(costs: list[float]) -> tuple[float, ...]:
    for _ in range(2):
        costs = [min(c, INSERT + costs[_wanted(s)]) for s, c in enumerate(costs)]
    return tuple(costs)


def _moves(row: int, state: int, after: tuple[float, ...]) -> Iterator[tuple[str, int, float]]:
    """Edits of a row: initial, what the conversation comes to, and the cost to the end."""
    yield "D", state, DELETE + after[state]
    if row != _GONE:
        initial, cut = row % 4, TRUNCATED * (row // 4)
        to = _kept(state, initial)
        if to is not None:
            yield "K", to, cut + after[to]
        yield "R", _wanted(state), REROLE + cut + after[_wanted(state)]


def _before(row: int, after: tuple[float, ...]) -> tuple[float, ...]:
    """Cheapest costs to the end from before a row, by what the conversation has come to."""
    if row == _NO_ROW:
        return after
    return _with_inserts([min(c for _, _, c in _moves(row, s, after)) for s in range(4)])


class Tables:
    """Transitions of cost vectors, less their least cost, for rows and for all blocks of rows.

    Costs of neighbouring states differ by little, so only few vectors occur; they are numbered as they are
    met from the end of a conversation. ``block[v][b]`` and ``cost[v][b]`` are the vector before block b and its
    least cost, where v is the vector after it; a block is numbered by its rows' classes, the first row's first.
    """

    def __init__(self) -> None:
        self.vectors = [_with_inserts([float("inf") if c is None else c for c in _ENDS])]
        number = {self.vectors[0]: 0}
        to: list[list[int]] = []
        cost: list[list[int]] = []
        for after in self.vectors:  # grows
            to.append([])
            cost.append([])
            for row in range(_CLASSES):
                made = _before(row, after)
                low = min(made)
                normal = tuple(c - low for c in made)
                if normal not in number:
                    number[normal] = len(self.vectors)
                    self.vectors.append(normal)
                to[-1].append(number[normal])
                cost[-1].append(low)
        self.row = to
        one, price = np.array(to), np.array(cost, np.int64)
        block, total = np.arange(len(to))[:, None], np.zeros((len(to), 1), np.int64)
        for _ in range(BLOCK):  # one more row in front
            total = (total[:, None, :] + price[block].transpose(0, 2, 1)).reshape(len(to), -1)
            block = one[block].transpose(0, 2, 1).reshape(len(to), -1)
        self.block, self.cost = block.tolist(), total.tolist()
        self.rows = list(product(range(_CLASSES), repeat=BLOCK))
        self._traced: dict[tuple[int, int, int], tuple[str, int]] = {}

    def _edits(self, row: int, state: int, after: int) -> tuple[str, int]:
        """Least initials among the cheapest edits up to and with a row, and the state after it."""
        ahead = self.vectors[after]
        here, out = _before(row, ahead), ""
        while True:
            choices = [(e, to) for e, to, c in _moves(row, state, ahead) if c == here[state]]
            if INSERT + here[_wanted(state)] == here[state]:
                choices.append(("I", _wanted(state)))
            edit, state = min(choices)
            out += edit
            if edit != "I":
                return out, state

    def trace(self, block: int, state: int, after: int) -> tuple[str, int]:
        """Edits of a block entered in a state: its inner vectors come from the one after it, backward."""
        key = (block, state, after)
        if (found := self._traced.get(key)) is None:
            rows, inner = self.rows[block], [after]
            for row in reversed(rows[1:]):
                inner.append(self.row[inner[-1]][row])
            edits = ""
            for row, ahead in zip(rows, reversed(inner), strict=True):
                if row != _NO_ROW:
                    more, state = self._edits(row, state, ahead)
                    edits += more
            found = self._traced[key] = edits, state
        return found

    def cheapest(self, rows: np.ndarray) -> tuple[int, str]:
        """Cost and initials of the cheapest edits of rows of these classes; of several, the least initials."""
        whole = np.full(-(-len(rows) // BLOCK) * BLOCK, _NO_ROW)
        whole[: len(rows)] = rows
        blocks = (whole.reshape(-1, BLOCK) @ (_CLASSES ** np.arange(BLOCK - 1, -1, -1))).tolist()
        at, cost, behind = 0, 0, []
        for b in reversed(blocks):
            behind.append(at)
            cost += self.cost[at][b]
            at = self.block[at][b]
        cost += int(self.vectors[at][_NOTHING])
        edits, state = [], _NOTHING
        for b in blocks:
            made, state = self.trace(b, state, behind.pop())
            edits.append(made)
        while _ENDS[state] is None:
            edits.append("I")
            state = _wanted(state)
        return cost, "".join(edits)


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


# --- rows in order ----------------------------------------------------------------


@dataclass(frozen=True)
class Repair:
    """``plans``: a row per conversation; ``rows``: the repaired turns."""

    plans: DataFrame
    rows: DataFrame


def _symbol(duplicate: Column) -> Column:
    """A letter for a row's initial and first fault."""
    last = F.right(F.rtrim(F.col("text"), F.lit(_WHITE)), F.lit(1))
    fault = F.when(last == "", 3).when(duplicate, 2).when(~last.isin(".", "!", "?"), 1).otherwise(0)
    first = F.left("role", F.lit(1))
    number = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    return F.char((F.lit(65) + number + 4 * fault).cast("int"))


def _symbols(rows: DataFrame) -> DataFrame:
    """Per conversation its rows as letters, in pieces: ``conv_id pieces(start, letters, low, high, turns)``.

    What was said before is found by counting and by the first place of equal rows, so no conversation
    has to be in one task for it. Letters are gathered by stretches of rows first; what is brought
    together of a conversation is a byte a row, as many as its edits.
    """
    key = [F.col("conv_id"), F.col("role"), digest_of(F.col("text")).alias("said")]
    again = rows.groupBy(*key).agg(F.min("order").alias("first"), F.count("*").alias("n")).where("n > 1")
    again = again.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("said").alias("s"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (digest_of(F.col("text")) == F.col("s"))
    slim = rows.join(again, same, "left").select(
        "conv_id", "order", F.col("turn").cast("long").alias("turn"), _symbol(F.coalesce(F.col("first") < F.col("order"), F.lit(False))).alias("letter")
    )
    letters = F.transform(F.array_sort(F.collect_list(F.struct("order", "letter"))), lambda x: x["letter"])
    pieces = slim.groupBy("conv_id", F.shiftright("order", GATHERED_BITS).alias("stretch")).agg(
        F.min("order").alias("start"),
        F.array_join(letters, "").alias("letters"),
        F.min("turn").alias("low"),
        F.max("turn").alias("high"),
        F.size(F.collect_set("turn")).cast("long").alias("turns"),
    )
    return pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("start", "letters", "low", "high", "turns"))).alias("pieces"))


def _gaps(pieces: list[dict]) -> int:
    """Turns that are missing between the least and the greatest; a turn that two pieces share counts once."""
    numbered = [p for p in pieces if p["low"] is not None]
    if not numbered:
        return 0
    shared = sum(a["high"] == b["low"] for a, b in zip(numbered, numbered[1:], strict=False))
    return numbered[-1]["high"] - numbered[0]["low"] + 1 - sum(p["turns"] for p in numbered) + shared


def _plan(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = tables()
    for b in batches:
        found: list[list] = [[] for _ in schema.names[1:]]
        for pieces in b.column("pieces").to_pylist():
            number = np.frombuffer("".join(p["letters"] for p in pieces).encode(), np.uint8) - 65
            initial, fault = number % 4, number // 4
            cost, audit = own.cheapest(np.where(fault > 1, _GONE, initial + 4 * fault))
            legal = ((initial[1:] == 1) & (initial[:-1] != 1) & (initial[:-1] != 3)) | ((initial[1:] == 2) & (initial[:-1] == 1))
            counts = np.bincount(fault, minlength=4).tolist()
            starts = [{"start": p["start"], "n": len(p["letters"])} for p in pieces]
            row = [_gaps(pieces), counts[3], counts[2], counts[1], int((~legal).sum()), cost, audit, _first_is_system(audit, initial), starts]
            for column, value in zip(found, row, strict=True):
                column.append(value)
        columns = [pa.array(c, f.type) for c, f in zip(found, list(schema)[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), *columns], schema=schema)


def _first_is_system(audit: str, initial: np.ndarray) -> bool:
    at = len(audit) - len(audit.lstrip("D"))
    return audit[at : at + 1] == "K" and initial[at] == 0


def _turns(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per turn that is left: its place, its edit, the row it comes from, and its new role if it has one."""
    held: list[list[pa.Array]] = []
    size = 0
    for b in batches:
        plans = zip(b.column("audit").to_pylist(), b.column("system").to_pylist(), b.column("starts").to_pylist(), strict=True)
        for i, (audit, system, starts) in enumerate(plans):
            edits = np.frombuffer(audit.encode(), np.uint8)
            orders = np.concatenate([np.zeros(0, np.int64), *(s["start"] + np.arange(s["n"]) for s in starts)])
            source = np.cumsum(edits != ord("I")) - 1
            left = np.flatnonzero(edits != ord("D"))
            for a in range(0, len(left), HANDED):
                part = left[a : a + HANDED]
                kind, place = edits[part], np.arange(a, a + len(part))
                inserted, same = kind == ord("I"), kind == ord("K")
                conv = b.column("conv_id").slice(i, 1).take(pa.array(np.zeros(len(part), np.int32)))
                names = pa.array(kind.view("S1").astype("U1").tolist(), pa.string())
                order = pa.array(orders[np.maximum(source[part], 0)] if len(orders) else place, mask=inserted)
                role = pa.array(np.where((place - int(system)) % 2 == 0, "user", "assistant").tolist(), pa.string(), mask=same)
                held.append([conv, pa.array(place), names, order, role])
                size += len(part)
                if size >= HANDED:
                    yield _together(schema, held)
                    held, size = [], 0
    if held:
        yield _together(schema, held)


def _together(schema: pa.Schema, held: list[list[pa.Array]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*held, strict=True)], schema=schema)


def repair(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> Repair:
    """The cheapest edits that make each conversation an optional system turn and pairs of user and assistant, or nothing.

    Rows are in the order of ``turn_col`` (null first), rows of one turn by role, then by text (its first 64
    characters, then its digest); rows that repeat stand next to each other. A null role or text
    counts as one space, and rows with a null id are one conversation. A row's first fault is ``blank``
    (white space only), ``duplicate`` (an earlier row has its role and text) or ``truncated`` (its last visible
    character is none of ``.!?``). Blank and duplicate rows are deleted. Of edits that cost the same, those
    whose initials (Delete, Insert, Keep, Rerole) are least count.

    ``plans`` has a row per conversation: ``conv_id gaps blank duplicate truncated illegal cost audit``.
    ``rows`` has ``conv_id place edit turn role text`` for what is left, with places from 0; inserted turns have
    an empty text and no turn. An empty table gives empty ones; other columns are not carried.

    The rows are dealt out by ranges of conversation and turn, so that a long conversation lies in many
    tasks, and stored once under a number that orders them. A byte a row makes up the text from
    which a conversation's edits are found; the edits meet their rows again by that number.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), space(role_col).alias("role"), space(text_col).alias("text")
    )
    by = ["conv_id", "turn", "role", F.left("text", F.lit(64)), F.md5("text")]
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("order", F.monotonically_increasing_id())
    rows = stage(rows, "repair_rows")
    conv = rows.schema["conv_id"]
    long = lambda *names: [T.StructField(n, T.LongType()) for n in names]
    starts = T.ArrayType(T.StructType(long("start", "n")))
    planned = T.StructType([
        conv, *long("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), T.StructField("audit", T.StringType()),
        T.StructField("system", T.BooleanType()), T.StructField("starts", starts),
    ])
    plans = stage(_symbols(rows).mapInArrow(partial(_plan, to_arrow_schema(planned)), planned), "repair_plans")
    left = T.StructType([conv, *long("place"), T.StructField("edit", T.StringType()), *long("order"), T.StructField("new", T.StringType())])
    turns = plans.select("conv_id", "audit", "system", "starts").mapInArrow(partial(_turns, to_arrow_schema(left)), left)
    old = rows.select("order", "turn", "role", "text")
    own = turns.where("edit <> 'I'").join(old, "order").withColumn("role", F.coalesce("new", "role"))
    added = turns.where("edit = 'I'").withColumn("turn", F.lit(None).cast(rows.schema["turn"].dataType)).withColumn("role", F.col("new"))
    names = ["conv_id", "place", "edit", "turn", "role", "text"]
    repaired = own.select(*names).unionByName(added.withColumn("text", F.lit("")).select(*names))
    return Repair(plans.drop("system", "starts"), repaired)


# --- damage and digests -----------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as ``conv_id turn role text`` with faults put in, by a checksum of conversation and turn.

    One row in twenty each: it goes, its text becomes empty, its text loses ``.!?``, it stands twice,
    it becomes the user's. Null roles and texts become one space; ids and turns stay null, and
    count as one space in the checksum.
    """
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = conversations.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), fault.alias("fault"))
    times = F.when(F.col("fault") == 0, 0).when(F.col("fault") == 3, 2).otherwise(1)
    each = rows.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times))
    )
    return each.drop("col")


EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _hashes(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the runs of a sorted stream; of a run only its state is held."""
    held: tuple[pa.Array, hashlib._Hash] | None = None
    for b in batches:
        if not b.num_rows:
            continue
        starts = [*run_starts(b, ["conv_id"]).tolist(), b.num_rows]
        ids, done = b.column("conv_id"), []
        lines = [f"{r}:{t}" for r, t in zip(b.column("role").to_pylist(), b.column("text").to_pylist(), strict=True)]
        for a, z in zip(starts, starts[1:], strict=False):
            text = "\n".join(lines[a:z])
            if a == 0 and held is not None and held[0][0].as_py() == ids[0].as_py():
                held[1].update(("\n" + text).encode())
                continue
            if held is not None:
                done.append(held)
            held = ids.slice(a, 1), hashlib.sha256(text.encode())
        if done:
            yield _digests(schema, done)
    if held is not None:
        yield _digests(schema, [held])


def _digests(schema: pa.Schema, done: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.concat_arrays([i for i, _ in done]), pa.array([h.hexdigest() for _, h in done])], schema=schema)


def digests(rows: DataFrame) -> DataFrame:
    """``conv_id repaired_sha256``: of ``role:text`` of the turns of each conversation, with line ends between.

    A digest is one computation after the other, so a conversation's rows stream through one task,
    sorted by Spark; what is held of them is a batch.
    """
    made = T.StructType([rows.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "role", "text")
    return ordered.mapInArrow(partial(_hashes, to_arrow_schema(made)), made)
