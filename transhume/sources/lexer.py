"""Cutting SQL files into statements in many tasks, whatever their line ends.

Files are split at every semicolon. A piece that begins and ends in code is a statement. Where
a semicolon lies in a literal, a name or a comment, the pieces around it belong together: each
piece maps every state in which it may begin to the state in which it then ends, the maps of
each split are composed, and a walk over the splits tells in which state each begins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transhume.session import stage

#: The states: code, ' literal, " literal, ` name, block comment, line comment.
STATES = "CSDNBL"

# Possessive quantifiers keep long literals from using up the regex stack.
SINGLE = r"'(?:[^'\\]++|\\.|'')*+'"
DOUBLE = r'"(?:[^"\\]++|\\.|"")*+"'
NAME = r"`[^`]*+`"
BLOCK = r"/\*(?:[^*]++|\*(?!/))*+\*/"
LINE = r"(?:--(?=\s)|#)[^\n]*+"
_CODE = rf"(?s)\A(?:[^'\"`\-#/]++|{SINGLE}|{DOUBLE}|{NAME}|{BLOCK}|{LINE}\n|-(?!-\s)|/(?!\*))*+(['\"`/#\-]?)"
# From within a state to the end of it.
_CLOSE = {
    "S": r"(?s)\A(?:[^'\\]++|\\.|'')*+'",
    "D": r'(?s)\A(?:[^"\\]++|\\.|"")*+"',
    "N": r"(?s)\A[^`]*+`",
    "B": r"(?s)\A(?:[^*]++|\*(?!/))*+\*/",
    "L": r"(?s)\A[^\n]*+\n",
}


def _from_code(text: Column) -> Column:
    """The state at the end of a text that begins in code."""
    opener = F.translate(F.regexp_extract(text, _CODE, 1), "'\"`/#-", "SDNBLL")
    return F.left(F.concat(opener, F.lit("C")), F.lit(1))


def _from_any(text: Column) -> Column:
    """The states at the end of a text, for each state at its beginning."""
    ends = [_from_code(text)]
    for state, close in _CLOSE.items():
        rest = F.regexp_replace(text, close, "")
        ends.append(F.when(text.rlike(close), _from_code(rest)).otherwise(F.lit(state)))
    return F.concat(*ends)


def read_pieces(spark: SparkSession, path: str, name_contains: str | None = None) -> DataFrame:
    """What lies between semicolons, stored once: ``file block order text ends``.

    ``block`` is where the split begins in the file, ``order`` rises within it, and ``ends`` is
    the state at the end of a piece that begins in code.
    """
    reader = spark.read.option("lineSep", ";")
    if name_contains is not None:
        reader = reader.option("pathGlobFilter", f"*{name_contains}*.sql")
    elif not path.endswith(".sql"):
        reader = reader.option("pathGlobFilter", "*.sql")
    pieces = reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("order"),
        F.col("value").alias("text"),
        _from_code(F.col("value")).alias("ends"),
    )
    return stage(pieces, "dump_pieces")


def statements(pieces: DataFrame) -> DataFrame:
    """Whole statements: ``file block order text``, at the place of their first piece.

    Files in which every piece ends in code pass through as they are. In the others only small rows,
    six states a piece, are sorted within their splits; a row a split reaches the driver, and the texts
    of those statements meet that have several pieces. The result is then stored once more.
    """
    names = ["file", "block", "order", "text"]
    opened = pieces.where("ends <> 'C'").select("file").distinct()
    if opened.isEmpty():
        return pieces.select(*names)
    maps = pieces.join(opened, "file", "left_semi").select("file", "block", "order", _from_any(F.col("text")).alias("ends"))
    maps = stage(maps.repartition("file", "block").sortWithinPartitions("file", "block", "order"), "dump_states")
    in_order = maps.repartition("file", "block").sortWithinPartitions("file", "block", "order")
    splits = in_order.mapInArrow(_composed, "file string, block long, ends string, heads array<long>").collect()
    begins, before = {}, None
    for s in sorted(splits, key=lambda s: (s.file, s.block)):
        if before is None or before[0] != s.file:
            before = (s.file, "C", None)
        _, state, head = begins[s.file, s.block] = before
        at = STATES.index(state)
        before = (s.file, s.ends[at], head if s.heads[at] < 0 else s.heads[at])
    links = stage(in_order.mapInArrow(partial(_linked, begins), "order long, head long"), "dump_links")
    heads = links.select("head").distinct().select(F.col("head").alias("order"), "head")
    several = pieces.join(links.unionByName(heads), "order")
    whole = several.groupBy("head").agg(
        F.first("file").alias("file"),
        F.min_by("block", "order").alias("block"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "order", "text"))), lambda p: p["text"]), ";").alias("text"),
    )
    single = pieces.join(links.select("order").unionByName(heads.select("order")), "order", "left_anti")
    return stage(single.select(*names).unionByName(whole.withColumnRenamed("head", "order").select(*names)), "dump_statements")


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split and state at its beginning: the state at its end, and its last piece that begins in code (-1: none)."""
    held: list | None = None

    def row(h: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([h[0]]), pa.array([h[1]], pa.int64()), pa.array(["".join(h[2])]), pa.array([h[3]], pa.list_(pa.int64()))],
            names=["file", "block", "ends", "heads"],
        )

    for b in batches:
        for r in b.to_pylist():
            if held is None or held[:2] != [r["file"], r["block"]]:
                if held is not None:
                    yield row(held)
                held = [r["file"], r["block"], list(STATES), [-1] * len(STATES)]
            for i, state in enumerate(held[2]):
                if state == "C":
                    held[3][i] = r["order"]
                held[2][i] = r["ends"][STATES.index(state)]
    if held is not None:
        yield row(held)


def _linked(begins: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces that do not begin in code, with the piece that their statement begins with."""
    at, state, head = None, "C", None
    for b in batches:
        found = []
        for r in b.to_pylist():
            if at != (r["file"], r["block"]):
                at = r["file"], r["block"]
                _, state, head = begins[at]
            if state == "C":
                head = r["order"]
            else:
                found.append((r["order"], head))
            state = r["ends"][STATES.index(state)]
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["order", "head"])
