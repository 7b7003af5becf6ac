"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transhume.session import stage


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest node reachable from each linked node.

    ``links`` has the columns ``a`` and ``b`` of any ordered type; direction, repeats,
    self links and links with a null end do not matter. Returns ``node`` and
    ``component`` for every node with a link to another node. An empty table gives an
    empty table.

    Nodes are moved to the smallest neighbour of their neighbours in alternating rounds
    (large star, small star) until every component is a star. Each round is two
    aggregations with partial sums and two joins that run-time skew handling can split;
    the result of a round is written to the shared folder, which cuts the lineage.
    Nothing but a count and a checksum reaches the driver.
    """
    edges = stage(_canonical(links), "links")
    before = _state(edges)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        edges = stage(_small_star(_large_star(edges)), "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"links have not settled after {max_rounds} rounds")
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionByName(centres)


def _canonical(links: DataFrame) -> DataFrame:
    return (
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
