"""Connected components of a link table, as Spark joins and aggregates.

Alternates large-star and small-star steps: every node hands its larger
(smaller) neighbours to its smallest neighbour until the links form stars.
The number of steps grows with the logarithm of the longest path. Nothing but
one row of counters per step reaches the driver. In the join that gives a
node's smallest neighbour back to its links, nodes with very many links are
joined by broadcast: those with more than ``hot_links`` and more than a
50,000th of all links, so at most 100,000 of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import cut


def _towards_smallest(arcs: DataFrame, above: int) -> DataFrame:
    """Arcs (u, v) with ``m``, the smallest of u and its neighbours."""
    least = arcs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    hot = F.broadcast(least.filter(F.col("n") > above).drop("n"))
    cold = least.filter(F.col("n") <= above).drop("n")
    others = arcs.join(hot.select("u"), "u", "left_anti").join(cold, "u")
    return arcs.join(hot, "u").unionByName(others).select("u", "v", "m")


def _step(links: DataFrame, above: int) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _towards_smallest(both, above).filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    down = cut(large.distinct(), "large_star")
    near = _towards_smallest(down, above)
    small = near.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
    return small.select("e.*").filter("u <> v").distinct()


def components(links: DataFrame, hot_links: int = 4096) -> DataFrame:
    """(node, component) for every node of ``links`` (columns ``u``, ``v``).

    ``component`` is the smallest node that can be reached. Links from a node
    to itself and repeated links change nothing; an empty table gives none.
    """
    mark = [F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))]
    now = cut(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "links")
    before = now.agg(*mark).collect()[0]
    while before[0]:
        now = cut(_step(now, max(hot_links, before[0] // 50_000)), "links")
        after = now.agg(*mark).collect()[0]
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
