"""Connected components of a table of links, in rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.session import staged

# Links shrink to stars in about log2(diameter) rounds; this only guards against a fault.
MOST_ROUNDS = 60


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))).select(
        "col.a", "col.b"
    )


def _to_smallest(links: DataFrame, upper: bool) -> DataFrame:
    """Links every node's neighbours to the smallest one, itself included.

    upper: neighbours above the node (a large star); else those below it (a small star). The
    smallest neighbour is found with a map-side combine. It is joined back from a written
    table, so Spark can split a node with very many neighbours.
    """
    if upper:
        arcs = _both_ways(links)
        smallest = arcs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        smallest = staged(smallest, "smallest")
        moved = arcs.filter("b > a").join(smallest, "a").select(F.col("low").alias("a"), "b")
    else:
        smallest = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("low"))
        smallest = staged(smallest, "smallest")
        joined = links.join(smallest, links["b"] == smallest["node"])
        moved = joined.select(
            F.explode(F.array(F.struct(F.col("low").alias("x"), F.col("a").alias("y")), F.struct(F.col("low").alias("x"), F.col("b").alias("y"))))
        ).select(F.col("col.x").alias("a"), F.col("col.y").alias("b"))
    return moved.filter("a < b").distinct()


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first())


def smallest_reachable(links: DataFrame) -> DataFrame:
    """Rows (node, component): for every node of a link, the smallest node it can reach.

    links has columns a and b, both long, in any order and any number of times. Links of a
    node to itself say nothing. Each round hangs the larger neighbours of a node, then the
    smaller ones, on the smallest; it ends when all links are stars. Each round is written to
    the shared folder, so a lost executor repeats one round at most.
    """
    stars = staged(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "links"
    )
    before = _digest(stars)
    for _ in range(MOST_ROUNDS):
        if not before[0]:
            break
        stars = staged(_to_smallest(_to_smallest(stars, upper=True), upper=False), "links")
        now = _digest(stars)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("links did not come to rest")
    ends = stars.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return ends.union(stars.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
