"""Connected components of an edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.session import cut_lineage


def _least(edges: DataFrame, gather) -> DataFrame:
    """The least neighbour of each node, cut off so that the join below can split a hub."""
    return cut_lineage(gather(edges.groupBy("u").agg(F.min("v").alias("m"))))


def _large(edges: DataFrame, gather) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both, gather).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame, gather) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down, gather)
    kept = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, links: int | None = None) -> DataFrame:
    """(u, v) links of bigint nodes to (node, root), root the least node reachable.

    Only nodes with a link to another node appear, and no root. The rounds grow with the
    logarithm of the longest path; each ends in a reliable checkpoint of one row per node.
    With ``links``, a round's tasks are no more than it takes at so many links a task: few
    links in many partitions leave mostly empty files.
    """
    state, edges = None, cut_lineage(edges.where("u <> v").distinct())
    tasks = -(-edges.count() // links) if links else None
    gather = lambda df: df.coalesce(max(1, tasks)) if links else df
    edges = gather(edges)
    while True:
        edges = gather(cut_lineage(gather(_large(edges, gather).where("u <> v").distinct())))
        edges = gather(cut_lineage(gather(_small(edges, gather).where("u <> v").distinct())))
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("u", "v", F.lit(7)), F.lit(1 << 31)))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
