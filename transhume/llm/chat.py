"""Conversations as training text, assembled column by column."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transhume.llm.text import runs, run_starts

#: Bytes of contents that are scattered at a time.
CHUNK = 2_000_000

#: Bytes of formatted texts that are handed over at a time, and conversations.
HANDED, STEP = 1 << 28, 256


@dataclass(frozen=True)
class Template:
    """Marks before the role, between role and text, and after the text of a turn.

    In roles and texts a backslash follows the first character of every control string,
    and backslashes are doubled, so that no control string is left and all can be read back.
    """

    before: str = "<|turn|>"
    between: str = "<|text|>"
    after: str = "<|end|>\n"
    others: tuple[str, ...] = ("<|endoftext|>", "<|startoftext|>", "<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.before.strip(), self.between.strip(), self.after.strip(), *self.others)

    def __post_init__(self) -> None:
        firsts = {c[0] for c in self.controls}
        if any(set(c[1:]) & firsts - {"<"} or "<" in c[2:] or "\\" in c for c in self.controls):
            raise ValueError("control strings must not overlap or hold a backslash")

    def escape(self, texts: pa.Array) -> pa.Array:
        out = pc.replace_substring(texts, "\\", "\\\\")
        return pc.replace_substring_regex(out, _any_of(self.controls), r"\1\\\2")

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def turns(self, formatted: str) -> Iterator[tuple[str, str, int, int]]:
        """Role and text of every turn, as they were, and where its text begins and ends."""
        parts = map(re.escape, (self.before, self.between, self.after))
        for m in re.finditer("{}(.*?){}(.*?){}".format(*parts), formatted, re.S):
            yield self.unescape(m[1]), self.unescape(m[2]), *m.span(2)


def _any_of(controls: tuple[str, ...]) -> str:
    """A pattern for every control string, its first character apart."""
    by_first: dict[str, list[str]] = {}
    for c in sorted(controls, key=len, reverse=True):
        by_first.setdefault(c[0], []).append(re.escape(c[1:]))
    if len(by_first) == 1:
        ((first, rests),) = by_first.items()
        return f"({re.escape(first)})({'|'.join(rests)})"
    chars = "".join(re.escape(f) for f in by_first)
    return f"([{chars}])({'|'.join(r for rests in by_first.values() for r in rests)})"


TEMPLATE = Template()


def assemble(template: Template, roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all turns one after the other, and where each turn begins (with the end as last entry).

    Segment lengths give cumulative offsets; marks are written to all turns at once,
    roles and texts through scatter indices.
    """
    marks = [np.frombuffer(m.encode(), np.uint8) for m in (template.before, template.between, template.after)]
    role_at, role_bytes = _buffers(roles)
    text_at, text_bytes = _buffers(texts)
    n_role, n_text = np.diff(role_at), np.diff(text_at)
    starts = np.concatenate([[0], np.cumsum(n_role + n_text + sum(map(len, marks)))])
    out = np.empty(starts[-1], np.uint8)
    at = starts[:-1]
    for mark, length in zip(marks, (n_role, n_text, None), strict=True):
        out[at[:, None] + np.arange(len(mark))] = mark
        at = at + len(mark) + (length if length is not None else 0)
    _scatter(out, starts[:-1] + len(marks[0]), role_at, role_bytes)
    _scatter(out, starts[:-1] + len(marks[0]) + n_role + len(marks[1]), text_at, text_bytes)
    return out, starts


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def _scatter(out: np.ndarray, to: np.ndarray, at: np.ndarray, data: np.ndarray) -> None:
    a = 0
    while a < len(to):
        b = max(a + 1, int(np.searchsorted(at, at[a] + CHUNK, side="right")) - 1)
        lengths = np.diff(at[a : b + 1])
        if b == a + 1:
            out[to[a] : to[a] + lengths[0]] = data[at[a] : at[b]]
        else:
            index = np.repeat(to[a:b] - at[a:b], lengths) + np.arange(at[a], at[b])
            out[index] = data[at[a] : at[b]]
        a = b


def _format(template: Template, learned: str, id_type: pa.DataType, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
    marks = [len(m) for m in (template.before, template.between, template.after)]
    for rows in runs(batches, ["conv_id"]):
        # Whole batches of texts may pass the 2 GiB that offsets of 32 bits reach.
        plain = [pa.concat_arrays(rows.column(c).cast(pa.large_string()).chunks) for c in ("role", "text")]
        roles, texts = (template.escape(c.fill_null("")) for c in plain)
        data, starts = assemble(template, roles, texts)
        firsts = run_starts(rows, ["conv_id"])
        turns = np.diff(np.concatenate([firsts, [rows.num_rows]]))
        bounds = np.concatenate([starts[firsts], starts[-1:]])
        # Code points before each turn of its conversation give the spans of what is learned.
        n_role, n_text = (pc.utf8_length(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (roles, texts))
        total = np.cumsum(n_role + n_text + sum(marks))
        before = total - (n_role + n_text + sum(marks))
        before -= np.repeat(before[firsts], turns)
        begin = before + marks[0] + n_role + marks[1]
        chosen = np.flatnonzero(pc.equal(plain[0], learned).fill_null(False).to_numpy(zero_copy_only=False))
        spans = pa.StructArray.from_arrays([pa.array(begin[chosen]), pa.array((begin + n_text)[chosen])], fields=list(span))
        cuts = np.searchsorted(chosen, np.concatenate([firsts, [rows.num_rows]]))
        formatted = pa.Array.from_buffers(pa.large_string(), len(firsts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        ids = rows.column("conv_id").combine_chunks().take(pa.array(firsts))
        a = 0
        while a < len(firsts):
            n = min(STEP, max(1, int(np.searchsorted(bounds, bounds[a] + HANDED, side="right")) - 1 - a), len(firsts) - a)
            lists = pa.ListArray.from_arrays(pa.array(cuts[a : a + n + 1].astype(np.int32)), spans)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, n).cast(id_type), pa.array(turns[a : a + n], pa.int64()), formatted.slice(a, n).cast(pa.string()), lists],
                names=["conv_id", "n_turns", "formatted", "loss_spans"],
            )
            a += n


def format_chats(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    learned: str = "assistant",
    template: Template = TEMPLATE,
) -> DataFrame:
    """One text per conversation: ``conv_id n_turns formatted loss_spans``.

    Turns are in the order of ``turn_col`` (null first), equal ones by role and text; rows that
    repeat are turns of their own. Null roles and texts count as empty; rows with a null
    id are one conversation. ``loss_spans`` are begin and end, in code points of ``formatted``, of
    the texts of role ``learned``. An empty table gives an empty one.

    Rows are sorted within partitions and streamed: a task holds the conversations of a batch,
    and one conversation whole, as the row that it becomes.
    """
    rows = conversations.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    span = T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])
    made = [rows.schema["conv_id"], T.StructField("n_turns", T.LongType()), T.StructField("formatted", T.StringType())]
    made.append(T.StructField("loss_spans", T.ArrayType(span)))
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(rows.schema["conv_id"].dataType)
    return rows.select("conv_id", "role", "text").mapInArrow(partial(_format, template, learned, id_type), T.StructType(made))


def _digests(template: Template, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: list[list] = [[], [], [], [], []]
        for text, spans in zip(b.column("formatted").to_pylist(), b.column("loss_spans").to_pylist(), strict=True):
            whole, n = hashlib.sha256(), 0
            for role, said, _, _ in template.turns(text):
                whole.update(f"{role}\n{said}\n".encode())
                n += 1
            learned = "".join(template.unescape(text[s["begin"] : s["end"]]) for s in spans)
            for column, value in zip(out, (n, whole.hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(text)), strict=True):
                column.append(value)
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [b.column("conv_id"), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
        )


def read_back(formatted: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Digests of what the formatted texts and their loss spans hold, one row per conversation."""
    made = [formatted.schema["conv_id"], T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType())]
    made += [T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())]
    return formatted.mapInArrow(partial(_digests, template), T.StructType(made))
