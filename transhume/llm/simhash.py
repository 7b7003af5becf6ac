"""Near-duplicate texts by SimHash fingerprints and BK-trees."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transhume.llm.components import components
from transhume.llm.text import SEED, batch, digest_of, run_starts, runs, shingle_hashes, words
from transhume.session import stage

BITS = 64

#: Fingerprints of one block of a shard; a larger shard is searched block against block.
BLOCK = 512

#: Nodes of a shard from which it is split by further bits.
LARGE = 8 * BLOCK


# --- fingerprints -----------------------------------------------------------------


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes; no hashes give zero."""
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[start : start + (1 << 16)])
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    """``doc_id`` and ``fp`` (64 bits as a long) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(partial(_fingerprints, shingle_words), f"doc_id {kind}, fp long")


def _fingerprints(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps = [fingerprint(shingle_hashes(words(t.as_py()), size)) for t in b.column("text")]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(np.array(fps, np.uint64).view(np.int64))], names=["doc_id", "fp"]
        )


# --- BK-tree ----------------------------------------------------------------------


class BKTree:
    """Fingerprints as a tree in which a child hangs at its Hamming distance to its parent."""

    def __init__(self, values: np.ndarray):
        self.values = np.asarray(values, np.uint64)
        plain, children = self.values.tolist(), [{} for _ in self.values]
        for i in range(1, len(plain)):
            at = 0
            while (nxt := children[at].setdefault((plain[at] ^ plain[i]).bit_count(), i)) != i:
                at = nxt
        counts = np.fromiter(map(len, children), np.int64, len(children))
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.edge = np.fromiter((d for c in children for d in c), np.int64, self.first[-1])
        self.child = np.fromiter((n for c in children for n in c.values()), np.int64, self.first[-1])

    def search(self, queries: np.ndarray, radius: int, step: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, tree value) within the radius, for some queries at a time.

        From a node at distance d only edges from d - radius to d + radius can lead to a
        hit (triangle inequality); all queries of a step go down the tree together.
        """
        queries = np.asarray(queries, np.uint64)
        for begin in range(0, len(queries) if len(self.values) else 0, step):
            q = np.arange(begin, min(begin + step, len(queries)))
            node = np.zeros(len(q), np.int64)
            hits = []
            while len(q):
                d = np.bitwise_count(queries[q] ^ self.values[node]).astype(np.int64)
                near = d <= radius
                hits.append((q[near], node[near]))
                fan = self.first[node + 1] - self.first[node]
                owner = np.repeat(np.arange(len(q)), fan)
                place = np.arange(len(owner)) - np.repeat(np.cumsum(fan) - fan, fan) + np.repeat(self.first[node], fan)
                follow = np.abs(self.edge[place] - d[owner]) <= radius
                q, node = q[owner[follow]], self.child[place[follow]]
            yield np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])


class Groups:
    """Components of a small set of items."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(*(v[self.label[a] != self.label[b]].tolist() for v in (a, b)), strict=True):
            x, y = sorted((self.label[x], self.label[y]))
            if x != y:
                self.label[self.label == y] = x


# --- shards -----------------------------------------------------------------------


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _masks(bits: list[int], radius: int, blocks: int) -> list[int]:
    """Masks of which two numbers that differ in at most ``radius`` of these bits agree on at least one.

    The bits are cut into ``blocks`` blocks; ``radius`` differing bits spoil at most as
    many blocks, so some ``blocks - radius`` blocks are equal. Every choice of so many
    blocks is a mask.
    """
    if blocks <= radius:
        raise ValueError("more blocks than differing bits are needed")
    bounds = [round(i * len(bits) / blocks) for i in range(blocks + 1)]
    own = [sum(1 << b for b in bits[bounds[i] : bounds[i + 1]]) for i in range(blocks)]
    return [sum(own[i] for i in chosen) for chosen in combinations(range(blocks), blocks - radius)]


def block_keys(fp: Column, radius: int, blocks: int) -> Column:
    """Shard keys that two fingerprints within the radius share at least one of (see ``_masks``)."""
    return F.array(*[fp.bitwiseAND(F.lit(_signed(m))) for m in _masks(list(range(BITS)), radius, blocks)])


def finer_masks(radius: int, blocks: int) -> list[list[int]]:
    """For each shard key of ``block_keys`` the masks by which a large shard is split: its own bits and some of the others."""
    out = []
    for mask in _masks(list(range(BITS)), radius, blocks):
        others = [b for b in range(BITS) if not mask >> b & 1]
        out.append([_signed(mask | m) for m in _masks(others, radius, 2 * radius)] if radius else [_signed(mask)])
    return out


def shards(nodes: DataFrame, keys: str, finer: list[list[int]] | None = None) -> DataFrame:
    """Rows of every shard with two or more nodes, with the cells in which they meet.

    A cell is a pair of blocks ``i <= j`` of a shard; a block has about ``BLOCK`` nodes,
    so that no task holds a whole frequent shard. Adds ``band``, ``key``, ``i``, ``j`` and
    ``left``/``right`` (the node belongs to block i, to block j). With ``finer`` (masks of ``fp`` for every
    band) a shard of more than ``LARGE`` nodes is split by further equal bits first, which loses no pair, so
    that its rows grow with its nodes and not with their square.
    """
    keyed = nodes.select("*", F.posexplode(keys).alias("band", "key"))
    if finer is not None:
        large = keyed.groupBy("band", "key").agg(F.count("*").alias("n")).where(F.col("n") > LARGE)
        keyed = keyed.join(large.select("band", "key", F.lit(True).alias("large")), ["band", "key"], "left")
        masks = F.element_at(F.lit(finer), F.col("band") + 1)
        split = F.transform(masks, lambda m: F.col("fp").bitwiseAND(m))
        own = F.when(F.col("large"), split).otherwise(F.array("key"))
        names = [c for c in nodes.columns]
        parts = keyed.select(*names, "band", "large", F.posexplode(own).alias("part", "key"))
        band = F.when(F.col("large"), len(finer) + F.col("band") * len(finer[0]) + F.col("part")).otherwise(F.col("band"))
        keyed = parts.select(*names, band.cast("int").alias("band"), "key")
    sizes = keyed.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    cut = sizes.select("band", "key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    placed = keyed.join(cut, ["band", "key"]).withColumn(
        "block", F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int")
    )
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.select(
        *nodes.columns,
        "band",
        "key",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        (F.col("block") <= F.col("other")).alias("left"),
        (F.col("block") >= F.col("other")).alias("right"),
    )


CELL = ["band", "key", "i", "j"]


def by_cell(rows: DataFrame) -> DataFrame:
    return rows.repartition(*CELL).sortWithinPartitions(*CELL)


def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    for table in runs(batches, CELL):
        starts = run_starts(table, CELL).tolist()
        for a, b in zip(starts, [*starts[1:], table.num_rows], strict=True):
            if b - a > 1:
                yield table.slice(a, b - a)


def _numbers(cell: pa.Table, name: str) -> np.ndarray:
    return cell.column(name).to_numpy()


def _sides(cell: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.flatnonzero(_numbers(cell, side)) for side in ("left", "right"))


def _found(cell: pa.Table, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a cell within the radius: the tree holds one block, the other block asks."""
    left, right = _sides(cell)
    fps = _numbers(cell, "fp").view(np.uint64)
    for q, node in BKTree(fps[left]).search(fps[right], radius):
        yield right[q], left[node]


def _stars(cell: pa.Table, groups: Groups, schema: pa.Schema) -> pa.RecordBatch:
    nodes = cell.column("node").combine_chunks()
    member = np.flatnonzero(groups.label != np.arange(cell.num_rows))
    return batch(schema, nodes.take(pa.array(member)), nodes.take(pa.array(groups.label[member])))


def _link_cells(radius: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for cell in cells(batches):
        groups = Groups(cell.num_rows)
        for a, b in _found(cell, radius):
            groups.link(a, b)
        if (out := _stars(cell, groups, schema)).num_rows:
            yield out


def fingerprint_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 3,
    radius: int = 3,
    blocks: int = 5,
) -> DataFrame:
    """Class of every row whose fingerprints are chained by at most ``radius`` differing bits.

    Returns ``doc_id``, ``fp`` and ``component_id``, the smallest id of the class (null only
    if no row of it has an id). Null and empty texts have fingerprint zero and are linked
    like any other. Equal fingerprints are one node however often they occur. Rows that
    repeat keep their number. An empty table gives an empty table.

    Distinct fingerprints go to shards of equal bits (exact, see ``block_keys``), each cell of
    a shard builds its BK-tree and sends on the links of a star per local class, which is
    as much as the classes need.
    """
    rows = stage(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    wanted = nodes.select(F.col("fp").alias("node"), "fp", block_keys(F.col("fp"), radius, blocks).alias("keys"))
    met = by_cell(shards(wanted, "keys", finer_masks(radius, blocks)).drop("keys"))
    linked = components(met.mapInArrow(partial(_link_cells, radius), "a long, b long"))
    labelled = nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    named = labelled.join(smallest, "component").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


# --- verified near duplicates -----------------------------------------------------

#: Odd factors: a product with one is a permutation of the 64-bit numbers.
_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def sketch_keys(hashes: np.ndarray, bands: int) -> np.ndarray:
    """One shard key a band, of two minima of permuted shingle hashes."""
    if not len(hashes):
        return np.arange(bands, dtype=np.int64)
    least = np.array([(hashes * f).min() for f in _FACTORS[: 2 * bands]]).reshape(bands, 2)
    mixed = (least[:, 0] * _FACTORS[-1]) ^ (least[:, 1] >> np.uint64(7)) ^ (least[:, 1] << np.uint64(57))
    return mixed.view(np.int64)


def _sketches(size: int, bands: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fps, keys = np.zeros(b.num_rows, np.uint64), np.zeros((b.num_rows, bands), np.int64)
        for i, t in enumerate(b.column("text")):
            # Distinct, as the similarity counts them: a phrase repeated at length must not turn the bits.
            hashes = np.unique(shingle_hashes(words(t.as_py()), size))
            fps[i], keys[i] = fingerprint(hashes), sketch_keys(hashes, bands)
        lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, bands, dtype=np.int32), keys.ravel())
        yield pa.RecordBatch.from_arrays(
            [b.column("node"), b.column("doc_id"), pa.array(fps.view(np.int64)), lists],
            names=["node", "doc_id", "fp", "keys"],
        )


def _active_cells(radius: int, bands: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a cell with a candidate in it; a pair counts in the first band that it shares."""
    for cell in cells(batches):
        keys = cell.column("keys").combine_chunks().flatten().to_numpy().reshape(-1, bands)
        band, active = cell.column("band")[0].as_py(), np.zeros(cell.num_rows, bool)
        for a, b in _found(cell, radius):
            other = a != b
            a, b = a[other], b[other]
            here = (keys[a] == keys[b]).argmax(axis=1) == band
            active[a[here]] = active[b[here]] = True
        if active.any():
            yield from cell.filter(pa.array(active)).drop_columns(["keys"]).combine_chunks().to_batches()


def _shingle_sets(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [np.unique(shingle_hashes(words(t.as_py()), size)).tobytes() for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(sets, pa.binary())], names=["node", "shingles"])


def _verify_cells(least: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of pairs whose sets have at least that Jaccard similarity.

    All similarities of a row come from the lists of the rows that hold each of its shingles.
    """
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    for cell in cells(batches):
        left, right = (np.zeros(cell.num_rows, bool) for _ in range(2))
        for side, at in zip((left, right), _sides(cell), strict=True):
            side[at] = True
        sets = [np.frombuffer(s.as_py(), np.uint64) for s in cell.column("shingles")]
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, codes = np.unique(np.concatenate(sets), return_inverse=True)
        order = np.argsort(codes, kind="stable")
        holders, first = owner[order], np.concatenate([[0], np.cumsum(np.bincount(codes))])
        ends, groups = np.cumsum(sizes), Groups(cell.num_rows)
        for x in np.flatnonzero(right).tolist():
            own = codes[ends[x] - sizes[x] : ends[x]]
            fan = first[own + 1] - first[own]
            place = np.arange(fan.sum()) - np.repeat(np.cumsum(fan) - fan, fan) + np.repeat(first[own], fan)
            shared = np.bincount(holders[place], minlength=len(sets))
            union = sizes + sizes[x] - shared
            alike = (shared >= least * union) & left
            alike[x] = False
            hits = np.flatnonzero(alike)
            groups.link(np.full(len(hits), x), hits)
        if (out := _stars(cell, groups, schema)).num_rows:
            yield out


def near_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    similarity: float = 0.8,
    radius: int = 22,
    bands: int = 10,
) -> DataFrame:
    """Class of every distinct text, chained by pairs of at least that Jaccard similarity of shingles.

    Returns ``node`` (128-bit digest of the text), ``doc_id`` (smallest id with that text) and
    ``component`` (smallest node of the class). Texts without words are one class. A pair is
    looked for where its fingerprints (of distinct shingles) differ in at most ``radius`` bits
    and one of ``bands`` sketch keys is equal; at similarity 0.8 the keys miss 1 pair in 27,000,
    and more than 22 bits differ in 1 of 29,000 (bits differ with probability 0.151 each; 16
    bits would miss 1 in 78). What is found is verified on whole shingle sets. Texts travel once, and only those with a candidate.
    """
    rows = docs.select(
        digest_of(F.col(text_col)).alias("node"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    sketched = rows.mapInArrow(
        partial(_sketches, shingle_words, bands), f"node binary, doc_id {kind}, fp long, keys array<long>"
    )
    sketched = stage(sketched, "sketches")
    nodes = sketched.groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("fp").alias("fp"), F.first("keys").alias("keys")
    )
    met = by_cell(shards(nodes.drop("doc_id"), "keys"))
    kinds = "node binary, fp long, band int, key long, i int, j int, left boolean, right boolean"
    active = stage(met.mapInArrow(partial(_active_cells, radius, bands), kinds), "active")
    chosen = nodes.select("node", "doc_id").join(active.select("node").distinct(), "node", "left_semi")
    texts = rows.join(chosen, rows["node"].eqNullSafe(chosen["node"]) & rows["doc_id"].eqNullSafe(chosen["doc_id"]), "left_semi")
    sets = texts.select("node", "text").mapInArrow(partial(_shingle_sets, shingle_words), "node binary, shingles binary")
    checked = by_cell(active.join(sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "node"))
    linked = components(checked.mapInArrow(partial(_verify_cells, similarity), "a binary, b binary"))
    return (
        nodes.select("node", "doc_id")
        .join(linked, "node", "left")
        .select("node", "doc_id", F.coalesce("component", "node").alias("component"))
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row of every class of near duplicates: the one with the smallest id (null is the largest).

    All columns stay, whatever their names. Among rows that repeat both id and text one stays.
    A class whose texts are null or empty keeps one row, too. See ``near_classes``.
    """
    classes = near_classes(docs, id_col, text_col, **how)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    best = classes.groupBy("component").agg(F.min(order).alias("best"))
    best = best.select(F.col("best.doc_id").alias("_best_id"), F.col("best.node").alias("_best_node"))
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), digest_of(F.col(text_col)).alias("_node"))
    marked = marked.withColumn("_id", F.col("_row")[id_col])
    kept = marked.join(
        best, F.col("_node").eqNullSafe(F.col("_best_node")) & F.col("_id").eqNullSafe(F.col("_best_id")), "left_semi"
    )
    once = Window.partitionBy("_node", "_id").orderBy("_node")
    return kept.withColumn("_n", F.row_number().over(once)).where("_n = 1").select("_row.*")
