"""Shards of fingerprints: no pair is lost, and a frequent shard's rows grow with its nodes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from transhume.llm import simhash

RADIUS, BLOCKS = 3, 5


def nodes_of(spark, numbers):
    rows = [(int(x), int(x)) for x in np.unique(np.asarray(numbers, np.uint64).view(np.int64))]
    df = spark.createDataFrame(rows, "node long, fp long")
    return df.withColumn("keys", simhash.block_keys(F.col("fp"), RADIUS, BLOCKS))


def pairs_that_meet(rows):
    cells, found = {}, set()
    for r in rows:
        cells.setdefault((r.band, r.key, r.i, r.j), []).append(r)
    for cell in cells.values():
        for a in cell:
            for b in cell:
                if a.left and b.right and a.node != b.node:
                    found.add(frozenset((a.node, b.node)))
    return found


@pytest.mark.parametrize("large", [2, 10, 10**9])
def test_pairs_within_the_radius_meet_whatever_is_split(spark, monkeypatch, large):
    monkeypatch.setattr(simhash, "LARGE", large)
    monkeypatch.setattr(simhash, "BLOCK", 4)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 12, np.uint64)
    numbers = list(base)
    for b in base:
        for n in (1, 2, 3, 3, 3, 4):
            numbers.append(b ^ np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, n, replace=False).astype(np.uint64)))
    numbers += [np.uint64(0x0F0F) | (np.uint64(k) << np.uint64(50)) for k in range(40)]
    nodes = nodes_of(spark, numbers)
    met = pairs_that_meet(simhash.shards(nodes, "keys", simhash.finer_masks(RADIUS, BLOCKS)).collect())
    values = [r.fp for r in nodes.collect()]
    for i, a in enumerate(values):
        for b in values[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= RADIUS:
                assert frozenset((a, b)) in met


def test_rows_of_a_frequent_shard_grow_with_its_nodes(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    monkeypatch.setattr(simhash, "LARGE", 128)
    rng = np.random.default_rng(2)
    made = []
    for n in (1500, 3000):
        numbers = rng.integers(0, 1 << 38, n, np.uint64) << np.uint64(26) | np.uint64(0x2ABCDEF)
        nodes = nodes_of(spark, numbers)
        made.append(simhash.shards(nodes, "keys", simhash.finer_masks(RADIUS, BLOCKS)).count())
        assert simhash.shards(nodes, "keys").count() > n * n / 16 / 2  # block against block
    assert made[0] < 5 * 1500 and made[1] < 5 * 3000  # what is left are shards of few nodes that agree by chance
