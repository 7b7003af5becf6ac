"""Quality of a text by a generalised additive model with pairwise interactions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labelled rows that a model is fitted on at most: those whose hash is smallest.
SAMPLE = 20_000

FEATURES = (
    "log_words",
    "word_length",
    "symbol_share",
    "punctuation_share",
    "upper_share",
    "digit_share",
    "space_share",
    "bar_share",
    "marked_words",
    "shouted_words",
    "distinct_words",
    "repeated_triples",
    "repeated_lines",
    "words_a_line",
    "closed_lines",
    "short_words",
)


def _class_table() -> np.ndarray:
    """Bit per byte class: 1 symbol, 2 punctuation, 4 upper, 8 digit, 16 space, 32 bar, 64 continuation of UTF-8."""
    table = np.zeros(256, np.uint8)
    for bit, members in ((1, b"#*$%&<>{}[]\\^~_=+@/"), (2, b".,;:!?\"'()-"), (8, b"0123456789"), (16, b" \t\n\x0b\x0c\r"), (32, b"|")):
        table[list(members)] |= bit
    table[0x41:0x5B] |= 4
    table[0x80:0xC0] |= 64
    return table


_CLASSES = _class_table()


def features(text: str | None) -> np.ndarray:
    """Numbers about a whole text, all finite; zero words give zeros."""
    out = np.zeros(len(FEATURES))
    data = text.encode() if text else b""
    raw = data.split()
    if not raw:
        return out
    counts = np.bincount(_CLASSES[np.frombuffer(data, np.uint8)], minlength=256)
    bits = np.arange(len(counts))
    of = lambda bit: counts[(bits & bit) > 0].sum()
    chars, words = len(data) - of(64), len(raw)
    visible = max(1, chars - of(16))
    ids = np.fromiter(map(hash_of, map(bytes.lower, raw)), np.uint64, words)
    triples = ids[:-2] * np.uint64(3) + ids[1:-1] * np.uint64(5) + ids[2:] * np.uint64(7) if words > 2 else ids[:0]
    lines = [line for line in data.split(b"\n") if line.strip()]
    ends = sum(w[-1:] in _MARKS for w in raw)
    out[:] = (
        np.log1p(words),
        visible / words,
        of(1) / visible,
        of(2) / visible,
        of(4) / visible,
        of(8) / visible,
        of(16) / chars,
        of(32) / visible,
        ends / words,
        sum(map(bytes.isupper, raw)) / words,
        len(np.unique(ids)) / words,
        1 - len(np.unique(triples)) / max(1, len(triples)) if len(triples) else 0.0,
        1 - len(set(lines)) / len(lines),
        np.log1p(words / len(lines)),
        sum(line.rstrip()[-1:] in _CLOSERS for line in lines) / len(lines),
        sum(len(w) < 4 for w in raw) / words,
    )
    return out


_MARKS = frozenset(bytes([b]) for b in b"#*$%&|<>!")
_CLOSERS = frozenset(bytes([b]) for b in b".!?\"'")
hash_of = xxhash.xxh64_intdigest


# --- model ------------------------------------------------------------------------


@dataclass
class Additive:
    """Score = sigmoid(base + a table entry per feature + a table entry per pair of features)."""

    base: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def logits(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[j], x[:, j], side="right")]
        coarse = {j: np.searchsorted(self.pair_cuts[j], x[:, j], side="right") for p in self.pairs for j in p}
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[coarse[a], coarse[b]]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -40, 40)))


def _quantile_cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="inverted_cdf"))


def _step(sums: np.ndarray, weights: np.ndarray, leaves: int, least: float) -> np.ndarray:
    """A shallow tree over ordered bins: the cuts with most gain, one after the other; a Newton step per leaf."""
    total, mass = np.concatenate([[0], np.cumsum(sums)]), np.concatenate([[0], np.cumsum(weights)])
    edges = [0, len(sums)]
    for _ in range(leaves - 1):
        best = (1e-12, None)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            k = np.arange(a + 1, b)
            left, right = mass[k] - mass[a], mass[b] - mass[k]
            fine = (left >= least) & (right >= least)
            if fine.any():
                gain = (total[k] - total[a]) ** 2 / (left + 1) + (total[b] - total[k]) ** 2 / (right + 1) - (total[b] - total[a]) ** 2 / (mass[b] - mass[a] + 1)
                at = int(np.where(fine, gain, -1).argmax())
                best = max(best, (float(gain[at]), int(k[at])), key=lambda t: t[0])
        if best[1] is None:
            break
        edges = sorted([*edges, best[1]])
    out = np.zeros(len(sums))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        out[a:b] = (total[b] - total[a]) / (mass[b] - mass[a] + 1)
    return out


def _pair_step(sums: np.ndarray, weights: np.ndarray, least: float) -> np.ndarray:
    """A tree of depth two over a pair of binned features: one cut of each, a Newton step per quadrant."""
    total, mass = (np.pad(m.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for m in (sums, weights))
    best, out = 0.0, np.zeros(sums.shape)
    n, m = sums.shape
    for i in range(1, n):
        for j in range(1, m):
            parts = [(slice(0, i), slice(0, j)), (slice(0, i), slice(j, m)), (slice(i, n), slice(0, j)), (slice(i, n), slice(j, m))]
            g = [total[i, j], total[i, m] - total[i, j], total[n, j] - total[i, j], total[n, m] - total[i, m] - total[n, j] + total[i, j]]
            h = [mass[i, j], mass[i, m] - mass[i, j], mass[n, j] - mass[i, j], mass[n, m] - mass[i, m] - mass[n, j] + mass[i, j]]
            gain = sum(a * a / (b + 1) for a, b in zip(g, h, strict=True))
            if gain > best:
                best = gain
                out = np.zeros(sums.shape)
                for part, a, b in zip(parts, g, h, strict=True):
                    out[part] = a / (b + 1) if b >= least else 0.0
    return out


def fit_additive(
    x: np.ndarray,
    y: np.ndarray,
    bins: int = 64,
    rounds: int = 150,
    rate: float = 0.1,
    leaves: int = 3,
    n_pairs: int = 6,
    pair_bins: int = 8,
    pair_rounds: int = 40,
) -> Additive:
    """Boost shallow trees over one feature at a time, in turn, then over the pairs that help most.

    Every round visits all features, so that none takes what another explains as well;
    the trees of a feature add up to its table. Pairs are ranked by the gain of one tree
    on what the single features leave over.
    """
    y = np.asarray(y, float)
    share = (y.sum() + 1) / (len(y) + 2)
    model = Additive(base=float(np.log(share / (1 - share))))
    model.cuts = [_quantile_cuts(x[:, j], bins) if len(x) else np.zeros(0) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    if len(np.unique(y)) < 2:
        return model
    binned = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(model.cuts)]
    logit, least = np.full(len(y), model.base), 1.0

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j, at in enumerate(binned):
            g, h = slope()
            size = len(model.tables[j])
            step = rate * _step(np.bincount(at, g, size), np.bincount(at, h, size), leaves, least)
            model.tables[j] += step
            logit += step[at]
    model.pair_cuts = [_quantile_cuts(x[:, j], pair_bins) for j in range(x.shape[1])]
    coarse = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(model.pair_cuts)]
    sizes = [len(c) + 1 for c in model.pair_cuts]

    def pair_tree(a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        g, h = slope()
        cell, size = coarse[a] * sizes[b] + coarse[b], sizes[a] * sizes[b]
        grid = [np.bincount(cell, v, size).reshape(sizes[a], sizes[b]) for v in (g, h)]
        return _pair_step(*grid, least), *grid

    gains = {}
    for a in range(x.shape[1]):
        for b in range(a + 1, x.shape[1]):
            step, g, _ = pair_tree(a, b)
            gains[a, b] = float((step * g).sum())
    model.pairs = sorted(gains, key=lambda p: (-gains[p], p))[:n_pairs]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for (a, b), table in zip(model.pairs, model.pair_tables, strict=True):
            step = rate * pair_tree(a, b)[0]
            table += step
            logit += step[coarse[a], coarse[b]]
    return model


# --- on tables --------------------------------------------------------------------


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
    **how,
) -> Additive:
    """A model of the labels of ``docs``, fitted on at most ``sample`` labelled rows.

    The sample are the labelled documents whose id has the smallest hash; below the bound it
    holds all of them. Rows with a null id or label are left out; an id with several labels
    takes the most frequent, the smaller of equally frequent ones; an id with several texts
    brings each, and of rows beyond the bound those whose features have the smallest hash count. Without both labels every text gets one score.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.mode(F.col(label_col), True).alias("label"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # Only ids and labels are sorted; texts come afterwards, for the chosen ids.
    present = rows.select("id").distinct().join(known, "id")
    chosen = present.orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(sample)
    picked = rows.join(F.broadcast(chosen), "id").select("label", "text").mapInArrow(_labelled, "label int, x array<double>")
    got = picked.orderBy(F.xxhash64("x"), "label").limit(sample).toArrow()
    x = np.array(got.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    return fit_additive(x, got.column("label").to_numpy() > 0, **how)


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = [features(t.as_py()).tolist() for t in b.column("text")]
        yield pa.RecordBatch.from_arrays(
            [b.column("label").cast(pa.int32()), pa.array(x, pa.list_(pa.float64()))], names=["label", "x"]
        )


def score_quality(docs: DataFrame, model: Additive, text_col: str = "text", score_col: str = "score", keep: list[str] | None = None) -> DataFrame:
    """Add ``score_col`` (0 to 1, higher is better) for every whole text; a column of that name is replaced.

    Null and empty texts have a score as well. Only the text counts. ``keep``: columns to return, all by default.
    """
    kept = [c for c in keep or docs.columns if c != score_col]
    rows = docs.select(F.col(text_col).alias("_text"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t.as_py()) for t in b.column("_text")]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [b.column("_row"), pa.array(held.value.scores(x))], names=["_row", "_score"]
            )

    out = rows.mapInArrow(score, T.StructType([rows.schema["_row"], T.StructField("_score", T.DoubleType())]))
    return out.select("_row.*", F.col("_score").alias(score_col))
