"""Connected components of a graph given as edges, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import delete, stash_at


def _shape(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _to_least(pairs: DataFrame, rows: int, larger_only: bool) -> DataFrame:
    """Each node's neighbours are tied to the least of them and it; the minimum combines early.

    A node with more than a quarter of a partition's share of the pairs, of which there can be 4 * width, meets its minimum by
    broadcast, so that the middle of a large star isn't one task's work.
    """
    width = max(1, int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count(F.lit(1)).alias("n"))
    is_hot = F.col("n") * (4 * width) > rows
    hot = F.broadcast(least.filter(is_hot).select("u", "m"))
    rest = pairs.join(hot, "u", "left_anti").join(least.filter(~is_hot).select("u", "m"), "u")
    tied = pairs.join(hot, "u").union(rest)
    if larger_only:
        return tied.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node and component (the least node that it is connected to), for every node of an edge between different nodes.

    Each round is written to the shared folder and the one before it deleted. Rounds stop when the edges, then stars around
    the least nodes, stay the same; their number grows with the logarithm of the number of nodes.
    """
    start = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    now, path = stash_at(start, "edges")
    shape = _shape(now)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large, large_path = stash_at(_to_least(both, 2 * shape[0], True).filter("u > v").distinct(), "stars")
        after, new_path = stash_at(_to_least(large, large.count(), False).filter("u > v").distinct(), "edges")
        delete(edges.sparkSession, path)
        delete(edges.sparkSession, large_path)
        now, path, was, shape = after, new_path, shape, _shape(after)
        if shape == was:
            break
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
