"""Connected components of an edge table (large-star / small-star rounds).

Every round is two grouped minima and joins on edges, so a node's neighbours
are never gathered in one place.  Each round's edges are written to the shared
checkpoint folder, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.session import cut_lineage


def _star(both: DataFrame, kept) -> DataFrame:
    """Link the neighbours of each node that ``kept`` selects to its smallest one."""
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").filter(kept)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``edges`` (u, v bigint) -> (node, root): the smallest node reachable.

    Nodes without an edge to another node are not listed (each is its own
    root).  Repeated and reversed edges and loops are allowed; an empty table
    gives an empty one."""
    u, v, m = F.col("u"), F.col("v"), F.col("m")
    now = cut_lineage(edges.filter(u != v)
                      .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    for _ in range(rounds):
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        both = now.unionByName(now.select(v.alias("u"), u.alias("v")))
        large = _star(both, v > u).select(v.alias("u"), m.alias("v")).filter("u != v").distinct()
        large = cut_lineage(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(v.alias("u"), m.alias("v")).unionByName(
            least.select("u", m.alias("v"))).filter("u != v").distinct()
        now = cut_lineage(small)
    else:
        raise RuntimeError(f"components: no fixed point within {rounds} rounds")
    return now.select(u.alias("node"), v.alias("root"))
