"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eodlake.llm.common import saved


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the larger (or all smaller) neighbours of each node under its smallest neighbour."""
    sides = _both(edges) if large else edges
    least = sides.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.col("u")).alias("least"))
    joined = sides.join(least, F.col("a") == F.col("u"))
    if large:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return joined.where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("least").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes in ``links`` (a, b), with the smallest node as name of each component.

    Each step is a few joins on node ids and is written, so a lost executor costs one step; a hub's rows only meet its
    minimum, which is aggregated before the shuffle. Steps follow until the links are stars and no longer change.
    """
    sums = [F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")]
    edges = saved(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = edges.agg(*sums).first()
    while before.n:
        edges = saved(_star(_star(edges, True).distinct(), False).where("a != b").distinct(), "links")
        after = edges.agg(*sums).first()
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
