"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HEAVY, discarded, spread, stored


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The smallest reachable id of every node that has an edge: ``(node, component)``.

    Alternates the large-star and small-star steps until the edges no longer change, which takes a
    number of rounds in the order of the logarithm of the longest path.  Each step is a grouped
    minimum (combined before the shuffle) and a join; no list of neighbours is ever built.  Nodes
    with over one in :data:`HEAVY` of all edges, of which there are fewer than that, meet their
    minimum by broadcast, so a hub's edges stay spread over the tasks that read them.  Every round
    is written to the shared folder, so the lineage stays one round long and a lost executor
    repeats one step.

    Null ends and loops are dropped.  An empty table gives an empty table.
    """
    pairs = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    pairs = pairs.where("u is not null and v is not null and u <> v")
    pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current = stored(pairs, "components")
    if current.isEmpty():
        return current.select(F.col("u").alias("node"), F.col("v").alias("component")).limit(0)
    signature, size = None, current.count()
    while True:
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: every larger neighbour is linked to the smallest of the neighbourhood
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("c"))
        large = _met(both.where("v > u"), least, 2 * size).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large, "components")
        # small star: every smaller neighbour, and the node, likewise
        down = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("c"))
        small = _met(large, down, large.count()).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        step = small.union(down.select("u", F.col("m").alias("v"))).distinct()
        following = stored(step, "components")
        now = following.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discarded(current, large)
        current, size = following, now[0]
        if tuple(now) == signature:
            break
        signature = tuple(now)
    roots = current.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _met(rows: DataFrame, minima: DataFrame, total: int) -> DataFrame:
    """Rows ``(u, v)`` with the minimum ``m`` of their ``u``, of which ``c`` of ``total`` rows have one."""
    heavy = F.broadcast(minima.where(F.col("c") * HEAVY > total).select("u", "m"))
    rest = minima.where(F.col("c") * HEAVY <= total).select("u", "m")
    return rows.join(heavy, "u").union(rows.join(heavy.select("u"), "u", "left_anti").join(spread(rest), "u"))
