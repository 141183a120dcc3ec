"""Connected components of a table of links."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

# Links that one task takes in a round.
TASK_LINKS = 1 << 15


def _lowest(edges: DataFrame) -> DataFrame:
    """Smallest node among each node and its neighbours."""
    return edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def grown(groups: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) as ``components`` gives them, once more links join the groups so far."""
    return components(links if groups is None else links.unionByName(groups.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node of its component.

    ``links`` has columns a and b of one comparable type. Each round hangs every
    node's larger neighbours, then its smaller ones, on the smallest node it
    knows. Only minima are aggregated, so no node's neighbours meet in one task
    beyond a skewed join, which adaptive execution splits. Each round is written
    to the shared folder, and has no more tasks than its links ask for: every
    task of a shuffle leaves files. Raises if ``max_rounds`` do not suffice; halving paths,
    they reach any path of a trillion nodes.
    """
    flip = lambda e: e.select(F.col("b").alias("a"), F.col("a").alias("b"))
    edges = stored(
        links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    mark = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    seen = mark(edges)
    if not seen[0]:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    tasks = math.ceil(2 * seen[0] / TASK_LINKS)
    for _ in range(max_rounds):
        one_way = edges.coalesce(tasks)
        both = one_way.unionByName(flip(one_way))
        large = both.join(_lowest(both), "a").where((F.col("b") > F.col("a")) & (F.col("b") != F.col("m"))).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.coalesce(tasks).distinct().coalesce(tasks)
        low = large.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks)
        small = large.join(low, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b")).coalesce(tasks)
        edges = stored(small.unionByName(low.withColumnRenamed("m", "b")).distinct().coalesce(tasks), "links")
        now = mark(edges)
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
    raise RuntimeError(f"components are not settled after {max_rounds} rounds")
