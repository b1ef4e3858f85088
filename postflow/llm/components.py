"""Connected components of an undirected graph by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.llm.common import stage


def _with_least(rows: DataFrame, least: DataFrame, n_edges: int) -> DataFrame:
    """``rows`` (u, v) with the least node ``m`` around ``u``.

    Nodes with more than a share of the edges get theirs by a broadcast, so their rows do not move: at most eight times the shuffle
    partitions can have that many. The rest is joined.
    """
    share = max(64, n_edges // (4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    hubs = least.where(F.col("k") >= share)
    near = rows.join(F.broadcast(hubs.select("u", "m")), "u")
    others = rows.join(F.broadcast(hubs.select("u")), "u", "left_anti").join(least.where(F.col("k") < share).select("u", "m"), "u")
    return near.unionByName(others)


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count(F.lit(1)).alias("k"))


def _large_star(edges: DataFrame, n_edges: int) -> DataFrame:
    """Every neighbour larger than ``u`` is linked to the smallest node around ``u``."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = _with_least(both.where("v > u"), _least(both), n_edges)
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame, n_edges: int) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = _with_least(down, least, n_edges).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) pairs of longs -> (node, root): the smallest node reachable, for every node on an edge.

    A node with many neighbours is reduced by a partial minimum before it is shuffled, and its rows get that minimum by a broadcast
    of bounded size instead of meeting in one task; no neighbour list is ever gathered. Each round is written to the
    shared folder, and the rounds end when the edges no longer change (logarithmic in the longest path).
    Self links and repeated links do no harm; no edges give no rows.
    """
    edges = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen or mark[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = tuple(mark)
        edges = stage(_small_star(_large_star(edges, mark[0]), mark[0]), "edges")
