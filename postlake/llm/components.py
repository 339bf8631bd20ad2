"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, measured, spread


#: Edges that one task of a star step holds, about; a step of few edges runs in few tasks, whatever the session's shuffle partitions.
_EDGES = 50_000


def _star(edges: DataFrame, large: bool, hot: int, parts: int) -> DataFrame:
    """One star step over edges (u, v) with u > v, written to the checkpoint folder.

    Large: every node's greater neighbours are linked to the least of the node and its neighbours. Small: every node's
    smaller neighbours are. Minima are aggregated before the shuffle; no neighbourhood is ever gathered as a list, and the
    minima of nodes with over `hot` neighbours are broadcast, so that none makes one task. `parts`: the most tasks that write.
    """
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    least = cut((least.select("u", F.least("u", "m").alias("m"), "n") if large else least).coalesce(parts))
    heavy = F.col("n") > hot
    with_least = lambda rows: rows.join(least, "u") if least.where(heavy).isEmpty() else spread(rows, least, ["u"], heavy)
    if large:
        linked = with_least(both.where("v > u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = with_least(edges).select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return measured(linked.where("u > v").distinct().coalesce(parts))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (columns a, b; any order, repeats and loops allowed): root is the least node reachable.

    Nodes that no edge between different nodes touches are left out; null ends are ignored. Each round is written to
    the shared checkpoint folder and compared with the one before by count and checksum; rounds grow with the logarithm
    of a component's size.
    """
    now = measured(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    n = now.count()
    seen, hot, parts = None, max(512, n // 2048), n // _EDGES + 1  # so at most 4096 nodes are hot
    now = now.coalesce(parts)
    while True:
        now = _star(_star(now, True, hot, parts), False, hot, parts)
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def labelled(classes: DataFrame, roots: DataFrame) -> DataFrame:
    """(set_key, component_id): components of classes (class, set_key, least id) are named by their least id; those without links stand alone."""
    owned = cut(roots.withColumnRenamed("node", "class").join(classes.select("class", "least"), "class"))
    named = cut(owned.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n")))
    owned = cut(spread(owned.select("class", "root"), named, ["root"], F.col("n") * 4096 > owned.count()).select("class", "component_id"))
    return cut(classes.join(owned, "class", "left").select("set_key", F.coalesce("component_id", "least").alias("component_id")))
