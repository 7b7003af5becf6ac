"""Shards of equal size in bytes, tokens and rows, by vector bin packing of groups of equal texts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transhume.llm.ranking import numbered
from transhume.llm.text import digest_of, words_of
from transhume.session import stage

#: Buckets of small groups; a bucket is placed as a whole.
BUCKETS = 4096

DIMENSIONS = ("bytes", "tokens", "rows")


#: What a deviation of bytes, tokens and rows counts when items are exchanged.
WEIGHTS = (4.0, 1.0, 1.0)

#: Pairs of items whose exchange is weighed at a time.
PAIRS = 1 << 18


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every item, the largest first: where its dot product with the residual capacity is highest.

    Vectors are divided by the capacity of a shard (an equal part of the total). Afterwards items are
    moved or exchanged between shards (see ``settle``).
    """
    total = vectors.sum(axis=0)
    scaled = vectors * shards / np.where(total > 0, total, 1)
    residual = np.ones((shards, vectors.shape[1]))
    at = np.zeros(len(vectors), np.int64)
    for i in np.lexsort((np.arange(len(vectors)), -scaled.max(axis=1))).tolist():
        at[i] = (residual @ scaled[i]).argmax()
        residual[at[i]] -= scaled[i]
    return settle(scaled, at, shards)


def settle(scaled: np.ndarray, at: np.ndarray, shards: int) -> np.ndarray:
    """Moves and exchanges of single items, each of which lessens the weighted squares of all deviations together.

    Between the fullest and the emptiest shard of a dimension, that with the widest spread first, the best move
    or exchange is made; it ends when none is left, or after a number of steps that grows with the shards.
    """
    weights = np.array(WEIGHTS)[: scaled.shape[1]]
    load = np.zeros((shards, scaled.shape[1]))
    np.add.at(load, at, scaled)
    for _ in range(64 + 8 * shards):
        for d in np.argsort(-np.ptp(load, axis=0) * np.sqrt(weights), kind="stable"):
            high, low = int(load[:, d].argmax()), int(load[:, d].argmin())
            found = _exchange(scaled, np.flatnonzero(at == high), np.flatnonzero(at == low), load[high] - load[low], weights)
            if found is not None:
                gives, takes = found
                change = scaled[gives].sum(axis=0) - scaled[takes].sum(axis=0)
                at[gives], at[takes] = low, high
                load[high] -= change
                load[low] += change
                break
        else:
            break
    return at


def _exchange(scaled: np.ndarray, mine: np.ndarray, theirs: np.ndarray, gap: np.ndarray, weights: np.ndarray):
    """The item to move across a gap, with the item to take for it or none, that lessens the squares most."""
    best, found = -1e-12, None
    # What moves v lessens the squares by 2 v (gap - v).
    own = np.concatenate([np.zeros((1, scaled.shape[1])), scaled[theirs]])
    step = max(1, PAIRS // len(own))
    for a in range(0, len(mine), step):
        v = scaled[mine[a : a + step]][:, None] - own[None]
        cost = (weights * v * (v - gap)).sum(axis=-1)
        i, j = np.unravel_index(cost.argmin(), cost.shape)
        if cost[i, j] < best:
            best, found = cost[i, j], ([mine[a + i]], [theirs[j - 1]] if j else [])
    return found


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16) -> DataFrame:
    """Shard and slot of every row: ``doc_id size text_crc32 tokens shard slot``.

    ``size`` is the UTF-8 length of the text plus 1 (null: 1), ``tokens`` its words. Law: sizes
    of shards are near equal; tokens and rows are balanced with them. Equal texts (null and empty alike) share a shard, unless they
    are more than a shard can take: such a group is cut into slices by row number. Slots count
    from 0 without a gap. Rows that repeat keep their number; an empty table gives none.

    Groups are summed before the shuffle. Those with more than 1/1024 of anything are placed
    one by one (3,072 at most, whatever the table), the others in 4,096 buckets by hash, so
    that the driver sees and sends a bounded list.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.size(words_of(F.col(text_col))).cast("long").alias("tokens"),
        digest_of(F.col(text_col)).alias("group"),
    )
    rows = stage(rows, "sizes")
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    groups = stage(rows.groupBy("group").agg(*sums), "groups")
    total = groups.agg(*[F.coalesce(F.sum(d), F.lit(0)).alias(d) for d in DIMENSIONS]).first()
    heavy = F.lit(False)
    for d in DIMENSIONS:
        heavy |= F.col(d) * 1024 > total[d]
    bucket = F.pmod(F.xxhash64("group"), F.lit(BUCKETS)).cast("int")
    large = groups.where(heavy).orderBy("group").collect()
    small = groups.where(~heavy).groupBy(bucket.alias("bucket")).agg(*[F.sum(d).alias(d) for d in DIMENSIONS])
    items, vectors = [], []
    for g in large:
        share = max(g[d] * shards / total[d] for d in DIMENSIONS if total[d])
        slices = int(np.ceil(4 * share)) if share > 1 else 1
        for k in range(slices):
            items.append((bytes(g.group), slices, None, k))
            vectors.append([g[d] / slices for d in DIMENSIONS])
    for b in small.orderBy("bucket").collect():
        items.append((None, 1, b.bucket, 0))
        vectors.append([float(b[d]) for d in DIMENSIONS])
    at = place(np.array(vectors, float).reshape(-1, len(DIMENSIONS)), shards).tolist()
    table = [(*item, s) for item, s in zip(items, at, strict=True)]
    spark = docs.sparkSession
    known = spark.createDataFrame(table, "group binary, slices int, bucket int, slice int, shard int")
    cut = F.broadcast(known.where("slice = 0 AND group IS NOT NULL").select("group", "slices"))
    sliced = rows.join(cut, "group", "left")
    # Only rows of groups beyond a shard are numbered, to cut them evenly.
    if any(item[1] > 1 for item in items):
        over = numbered(sliced.where("slices > 1"), ["group"], "n", "sliced")
        over = over.withColumn("slice", (F.col("n") % F.col("slices")).cast("int")).drop("n")
        sliced = sliced.where("slices IS NULL OR slices = 1").withColumn("slice", F.lit(0)).unionByName(over)
    else:
        sliced = sliced.withColumn("slice", F.lit(0))
    by_group = F.broadcast(known.where("group IS NOT NULL").select("group", "slice", F.col("shard").alias("own")))
    by_bucket = F.broadcast(known.where("group IS NULL").select(F.col("bucket").alias("_bucket"), F.col("shard").alias("common")))
    placed = (
        sliced.join(by_group, ["group", "slice"], "left")
        .join(by_bucket, F.when(F.col("own").isNull(), bucket) == F.col("_bucket"), "left")
        .select("doc_id", "size", "text_crc32", "tokens", F.coalesce("own", "common").alias("shard"))
    )
    return numbered(placed, ["shard"], "slot", "placed")
