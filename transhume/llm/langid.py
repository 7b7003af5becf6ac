"""Language of a text by the ranks of its most frequent n-grams."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transhume.llm.text import batch

#: n-grams of a profile, and of a document that are compared with it.
PROFILE = 400

#: Longest n-gram, in letters.
LONGEST = 3

UNKNOWN = "und"

#: Distinct n-grams that a task holds before it sends its counts on.
HELD = 2_000_000

_CODE_BITS = 21


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def letters_of(text: str | None) -> np.ndarray:
    """Lower-case code points with a zero in place of every run of other characters, also at both ends."""
    if not text:
        return np.zeros(1, np.int64)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    codes = np.concatenate([[0], np.where(_letters()[codes], codes, 0), [0]])
    return codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]


def grams_of(codes: np.ndarray, longest: int) -> np.ndarray:
    """Numbers of all n-grams of 1 to ``longest`` characters; a zero marks the edge of a word.

    Grams that hold an edge anywhere but at their ends, and the bare edge, are left out.
    """
    out = []
    for n in range(1, longest + 1):
        if len(codes) < n:
            break
        gram, inner = codes[: len(codes) - n + 1].copy(), np.ones(len(codes) - n + 1, bool)
        for k in range(1, n):
            part = codes[k : len(codes) - n + 1 + k]
            gram = (gram << _CODE_BITS) | part
            if k < n - 1:
                inner &= part != 0
        inner &= (gram != 0) if n < 3 else inner
        out.append(gram[inner])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order, and how often each occurs."""
    grams = np.sort(grams)
    starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
    return grams[starts], np.diff(np.concatenate([starts, [len(grams)]]))


@dataclass(frozen=True)
class Profiles:
    """Ranks of n-grams by language; where a language lacks one, ``size`` (the largest distance)."""

    langs: tuple[str, ...]
    grams: np.ndarray
    ranks: np.ndarray
    size: int
    longest: int

    def predict(self, text: str | None) -> tuple[str, float]:
        """Nearest language and 1 - its out-of-place distance over the largest possible one."""
        codes = letters_of(text)
        if not self.langs or not codes.any():
            return UNKNOWN, 0.0
        grams, n = counted(grams_of(codes, self.longest))
        top = np.argsort(-n, kind="stable")[: self.size]  # ties in the order of the n-grams
        grams = grams[top]
        place = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        known = self.grams[place] == grams
        theirs = self.ranks[place[known]]
        apart = np.abs(theirs - np.flatnonzero(known)[:, None])
        apart[theirs == self.size] = self.size
        distance = apart.sum(axis=0) + self.size * (~known).sum()
        best = int(distance.argmin())
        return self.langs[best], float(1 - distance[best] / (self.size * len(grams)))


def _counts(longest: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams by language, summed over the batches of a task."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, (grams, n) in held.items():
            for a in range(0, len(grams), 50_000):
                part = grams[a : a + 50_000]
                yield batch(schema, [lang] * len(part), part, n[a : a + 50_000])
        held.clear()

    def add(lang: str, parts: list[np.ndarray]) -> None:
        grams, n = counted(np.concatenate(parts))
        if lang in held:
            grams = np.concatenate([held[lang][0], grams])
            n = np.concatenate([held[lang][1], n])
            order = np.argsort(grams, kind="stable")
            grams, n = grams[order], n[order]
            starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
            grams, n = grams[starts], np.add.reduceat(n, starts)
        held[lang] = grams, n

    for b in batches:
        waiting: dict[str, list[np.ndarray]] = {}
        size = 0
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text"), strict=True):
            grams = grams_of(letters_of(text.as_py()), longest)
            if len(grams):
                waiting.setdefault(lang, []).append(grams)
                size += len(grams)
            if size > HELD:
                for k, parts in waiting.items():
                    add(k, parts)
                waiting, size = {}, 0
        for k, parts in waiting.items():
            add(k, parts)
        if sum(len(g) for g, _ in held.values()) > HELD:
            yield from flush()
    yield from flush()


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = PROFILE, longest: int = LONGEST) -> Profiles:
    """Profile of every language of ``docs``: its ``size`` most frequent n-grams, ties by n-gram.

    Counts cover all whole texts; tasks sum their own before the shuffle. Rows with a null
    language or without letters add nothing. The driver gets ``size`` rows a language. With
    nothing to learn from, every text is ``und``.
    """
    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    counts = rows.mapInArrow(partial(_counts, longest), "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < size).collect()
    langs = tuple(sorted({r.lang for r in top}))
    grams = np.array(sorted({r.gram for r in top}), np.int64)
    ranks = np.full((len(grams), len(langs)), size, np.int64)
    at = {lang: i for i, lang in enumerate(langs)}
    for r in top:
        ranks[np.searchsorted(grams, r.gram), at[r.lang]] = r["rank"]
    return Profiles(langs, grams, ranks, size, longest)


def identify(docs: DataFrame, profiles: Profiles, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score", keep: list[str] | None = None) -> DataFrame:
    """Add the predicted language and its score (0 to 1) to every row; columns of those names are replaced.

    The whole text counts. A text that is null or has no letter is ``und`` with score 0.
    Equally near languages are taken in the order of their names. ``keep``: columns to return, all by default.
    """
    kept = [c for c in keep or docs.columns if c not in (lang_col, score_col)]
    rows = docs.select(F.col(text_col).alias("_text"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"))
    held = docs.sparkSession.sparkContext.broadcast(profiles)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [held.value.predict(t.as_py()) for t in b.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("_row"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["_row", "_lang", "_score"],
            )

    made = [rows.schema["_row"], T.StructField("_lang", T.StringType()), T.StructField("_score", T.DoubleType())]
    out = rows.mapInArrow(predict, T.StructType(made))
    return out.select("_row.*", F.col("_lang").alias(lang_col), F.col("_score").alias(score_col))
