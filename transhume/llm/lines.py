"""Repeated and nearly repeated lines, by a join on deletion neighbourhoods."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transhume.llm.ranking import numbered
from transhume.llm.text import batch, digest_of
from transhume.session import stage

#: Lines with fewer characters (words with one space apart) are never removed: marks, numbers and rules.
MIN_LETTERS = 8

#: Lines of fewer words are removed if they are equal to an earlier one, not if they are a word apart.
MIN_WORDS = 8


def normal_line(line: Column) -> Column:
    """Words of a line in lower case, one space apart; empty for a blank line."""
    low = F.lower(line)
    # Searching for bytes is much faster than a pattern, and few lines hold anything but single spaces.
    odd = F.startswith(low, F.lit(" ")) | F.endswith(low, F.lit(" "))
    for blank in ("  ", "\t", "\x0b", "\x0c", "\r"):
        odd |= F.contains(low, F.lit(blank))
    return F.when(odd, F.trim(F.regexp_replace(low, r"[\x20\x09-\x0D]+", " "))).otherwise(low)


def word_count(line: Column) -> Column:
    """Number of words of a normal line."""
    return F.when(line == "", 0).otherwise(F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1)


def raw_lines(docs: DataFrame, id_col: str, text_col: str, min_letters: int) -> DataFrame:
    """``doc_id``, ``doc`` (digest of the whole text), ``at`` (number of the line) and ``raw``, the line.

    Lines too short for so many letters are left out.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), digest_of(F.col(text_col)).alias("doc"), F.col(text_col).alias("text"))
    split = rows.select("doc_id", "doc", F.posexplode(F.split("text", "\n")).alias("at", "raw"))
    return split.where(F.octet_length("raw") >= min_letters)


def occurrences(lines: DataFrame, min_letters: int, min_words: int) -> DataFrame:
    """Of every line of at least ``min_letters`` letters its place, ``h`` (128-bit digest of its words) and
    ``keys``, which are null for lines of fewer than ``min_words`` words."""
    lined = lines.select("doc_id", "doc", "at", normal_line(F.col("raw")).alias("line"))
    counted = lined.select("doc_id", "doc", "at", "line", word_count(F.col("line")).alias("words"))
    keys = F.when(F.col("words") >= min_words, half_keys(F.col("line"), F.col("words")))
    keyed = counted.select(
        "doc_id", "doc", "at", F.char_length("line").alias("letters"), line_digest(F.col("line")).alias("h"), keys.alias("keys")
    )
    # Stored before short lines are left out: a filter would make each line normal once more.
    return stage(keyed, "occurrences").where(F.col("letters") >= min_letters).drop("letters")


def line_digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def place() -> Column:
    """Order of occurrences: by id (null last), then digest of the text, then line."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "doc", "at")


def half_keys(line: Column, n: Column) -> Column:
    """Keys of which two lines (normal, of ``n`` words) share one if they are a word edit apart.

    An edit lies in the first or in the second half, so the other half is equal. Halves are
    those of the shorter line of a pair; a line is keyed as the shorter and as the longer.
    """
    keys = []
    for short in (n, n - 1):
        half = F.floor(short / 2).cast("int")
        for side, words in ((0, half), (1, half - short)):
            part = F.call_function("substring_index", line, F.lit(" "), words)
            keys.append(F.xxhash64(F.lit(side), short, part))
    return F.array(*keys)


# --- deletion neighbourhood --------------------------------------------------------

_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xC2B2AE3D27D4EB4F)


def variants(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the whole line (first) and of the line without each of its words.

    Polynomial hashes over word hashes, from prefix sums: one pass, whatever the length.
    """
    n = len(tokens)
    out = []
    for base, seed in ((_P, 1), (_Q, 2)):
        h = np.fromiter((xxhash.xxh64_intdigest(t, seed) for t in tokens), np.uint64, n)
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base)]))
        before = np.concatenate([[np.uint64(0)], np.cumsum(h * power[:n])])
        shifted = np.concatenate([[np.uint64(0)], np.cumsum(h[1:] * power[: n - 1])]) if n > 1 else np.zeros(1, np.uint64)
        without = before[:n] + (shifted[-1] - shifted[:n])
        out.append(np.concatenate([[before[-1]], without]))
    return out[0].view(np.int64), out[1].view(np.int64)


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("cut", pa.int32()), ("rank", pa.int64())])
    for b in batches:
        found, size = [], 0
        for line, rank in zip(b.column("line").to_pylist(), b.column("rank").to_pylist(), strict=True):
            k1, k2 = variants(line.encode().split(b" "))
            found.append((k1, k2, np.arange(-1, len(k1) - 1, dtype=np.int32), np.full(len(k1), rank)))
            size += len(k1)
            if size > 200_000:
                yield batch(schema, *map(np.concatenate, zip(*found, strict=True)))
                found, size = [], 0
        if found:
            yield batch(schema, *map(np.concatenate, zip(*found, strict=True)))


def within_one_edit(a: list[str], b: list[str]) -> bool:
    """Whether one inserted, deleted or replaced word at most makes ``b`` of ``a``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i:] == b[i + 1 :] or a[i + 1 :] == b[i + 1 :]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        pairs = zip(b.column("line").to_pylist(), b.column("other").to_pylist(), strict=True)
        yield b.select(["rank"]).filter(pa.array([within_one_edit(x.split(" "), y.split(" ")) for x, y in pairs], pa.bool_()))


def place_hash() -> Column:
    return F.xxhash64("doc_id", "doc", "at").alias("place")


def near_lines(distinct: DataFrame, lines: DataFrame) -> DataFrame:
    """``h`` of every distinct line that has an earlier line one word edit away."""
    keyed = distinct.select("h", F.explode("keys").alias("key"))
    met = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    active = keyed.join(met, "key", "left_semi").select("h").distinct()
    first = distinct.select("h", "n", "first.*").drop("none")
    # One occurrence of each active line brings its text.
    wanted = first.join(active, "h", "left_semi").withColumn("place", place_hash())
    brought = wanted.join(lines.select("doc", place_hash(), "raw"), ["doc", "place"])
    # Stored before they are sorted, as sorting by range reads its input twice.
    texts = stage(brought.select("h", "n", "doc_id", "doc", "at", normal_line(F.col("raw")).alias("line")), "active_lines")
    # Places are equal by hash; a filter in the join above would be evaluated for every line.
    texts = texts.where(line_digest(F.col("line")) == F.col("h"))
    # A row that is repeated brings its lines again; a line must not be near to itself.
    texts = texts.where("n = 1").unionByName(texts.where("n > 1").dropDuplicates(["h"]))
    order = [F.col("doc_id").asc_nulls_last(), "doc", "at", "h"]
    ranked = numbered(texts.repartitionByRange(*order).sortWithinPartitions(*order).select("h", "line"), [], "rank", "lines")
    ranked = stage(ranked, "ranked_lines")
    cut = ranked.select("line", "rank").mapInArrow(_variants, "k1 long, k2 long, cut int, rank long")
    whole = F.col("cut") < 0
    equal = cut.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min(F.when(whole, F.col("rank"))).alias("whole"))
    hits = stage(cut.join(equal.where("n > 1").select("k1", "k2", "whole"), ["k1", "k2"]), "variants")
    # Lines that are equal but for one word: all are linked to the earliest of them.
    least = hits.where("cut >= 0").groupBy("k1", "k2", "cut").agg(F.min("rank").alias("earlier"))
    replaced = hits.where("cut >= 0").join(least, ["k1", "k2", "cut"]).select("rank", "earlier")
    # A line that is another without a word.
    longer = hits.where("cut >= 0 AND whole IS NOT NULL")
    inserted = longer.select(F.greatest("rank", "whole").alias("rank"), F.least("rank", "whole").alias("earlier"))
    pairs = replaced.unionByName(inserted).where("rank > earlier").distinct()
    text = ranked.select("rank", "line")
    other = text.select(F.col("rank").alias("earlier"), F.col("line").alias("other"))
    checked = pairs.join(text, "rank").join(other, "earlier").select("rank", "line", "other")
    later = checked.mapInArrow(_verified, "rank long").distinct()
    return ranked.join(later, "rank", "left_semi").select("h").distinct()


def repeated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_letters: int = MIN_LETTERS
) -> DataFrame:
    """Numbers of the lines to remove: ``doc_id``, ``doc`` (digest of the text), ``cut`` (array of int)."""
    lines = raw_lines(docs, id_col, text_col, min_letters)
    found = occurrences(lines, min_letters, min_words)
    distinct = stage(
        found.groupBy("h").agg(F.min(place()).alias("first"), F.count("*").alias("n"), F.first("keys").alias("keys")),
        "distinct_lines",
    )
    near = near_lines(distinct, lines).withColumn("near", F.lit(True))
    marked = distinct.join(near, "h", "left").where("n > 1 OR near").select(
        "h", F.col("first.doc_id").alias("first_id"), F.col("first.doc").alias("first_doc"),
        F.col("first.at").alias("first_at"), F.coalesce("near", F.lit(False)).alias("near"),
    )
    # Stored, so that both sides of the join below are read by themselves and a line that very
    # many documents share can be split at run time.
    marked = stage(marked, "repeated_lines")
    is_first = (
        F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("doc") == F.col("first_doc")) & (F.col("at") == F.col("first_at"))
    )
    gone = found.drop("keys").join(marked, "h").where(F.col("near") | ~is_first)
    return gone.groupBy("doc_id", "doc").agg(F.collect_set("at").alias("cut"))


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    cut_col: str = "lines_cut",
    drop_emptied: bool = True,
    min_letters: int = MIN_LETTERS,
) -> DataFrame:
    """Documents without the lines that an earlier line repeats, but for at most one word.

    Lines end at ``\\n``. Two lines are alike if their words (lower case, apart by white
    space) are equal or, where both have ``min_words`` words or more, differ by one inserted, deleted or replaced
    word. Of alike lines the
    earliest stays, by id (null last), digest of the text and line; a line goes if any
    earlier line is alike, whether or not that one stays. Lines of fewer than ``min_letters``
    characters, as words with one space apart, always stay; so lines of a script without spaces are
    compared as whole ones. Returns all columns with ``text_col`` cut and ``cut_col`` added (lines
    removed; a column of that name is replaced). A document that lost lines and has no word
    left goes if ``drop_emptied``; documents that were empty or null stay as they are. Rows
    that repeat both id and text are one document and are cut alike.

    Candidates come from equal keys of deletion variants: of every line that shares a half
    with another (see ``half_keys``), the line and the line without each word. Lines equal
    without their i-th word are linked to the earliest of them only, so that frequent
    variants make no pairs. Each link is verified on the words.
    """
    kept = [c for c in docs.columns if c != cut_col]
    cuts = repeated(docs, id_col, text_col, min_words, min_letters)
    cuts = cuts.select(F.col("doc_id").alias("_cut_id"), F.col("doc").alias("_cut_doc"), F.col("cut").alias("_cut"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), digest_of(F.col(text_col)).alias("_doc"))
    met = rows.join(
        cuts, F.col("_row")[id_col].eqNullSafe(F.col("_cut_id")) & (F.col("_doc") == F.col("_cut_doc")), "left"
    ).select(F.col("_row")[text_col].alias("_text"), "_row", "_cut")
    out = met.mapInArrow(_apply, T.StructType([*met.schema, T.StructField("_n", T.IntegerType()), T.StructField("_left", T.BooleanType())]))
    if drop_emptied:
        out = out.where("_n = 0 OR _left")
    fields = [F.col("_text" if c == text_col else f"_row.`{c}`").alias(c) for c in kept]
    return out.select(*fields, F.col("_n").alias(cut_col))


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, numbers, left = [], [], []
        for text, cut in zip(b.column("_text").to_pylist(), b.column("_cut").to_pylist(), strict=True):
            if cut:
                gone = set(cut)
                text = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)
            texts.append(text)
            numbers.append(len(cut or ()))
            left.append(bool(text and text.strip()))
        arrays = [pa.array(texts, b.column("_text").type), *b.columns[1:], pa.array(numbers, pa.int32()), pa.array(left)]
        yield pa.RecordBatch.from_arrays(arrays, names=[*b.schema.names, "_n", "_left"])
