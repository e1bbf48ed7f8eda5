"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014).

Scale: edges are two longs. A hub's edges are one join key; the other side of that join has one row a key, so
adaptive execution's skew join splits a hub over tasks, and the minimum of a key is combined before its shuffle.
Up to `ONE_TASK` edges (their count is taken each round) lie in one partition, so that rounds over few edges need no
exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


ONE_TASK = 200_000


def _both(edges: DataFrame) -> DataFrame:
    ways = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return edges.select(F.explode(ways).alias("e")).select("e.src", "e.dst")  # a union would have twice the partitions


def _star(edges: DataFrame, large: bool, few: bool) -> DataFrame:
    """large: edges point both ways, and each node ties its larger neighbours to the least of its neighbourhood.
    small: edges point from the larger end, and each node ties itself and its neighbours to the least of them.
    few: all edges are in one partition, and so is the result."""
    least = edges.groupBy("src").agg(F.least(F.min("dst"), F.first("src")).alias("m"))
    joined = edges.join(least, "src")
    out = joined.filter(F.col("dst") > F.col("src")) if large else joined.filter(F.col("dst") != F.col("m"))
    out = out.select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    if not large:
        out = out.unionByName(least.select("src", F.col("m").alias("dst")))
    out = out.coalesce(1) if few else out  # else Spark does not know that it is one partition
    return out.filter(F.col("src") != F.col("dst")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, label (the least node of its component) of all nodes of edges (src, dst; loops and repeats do no
    harm). Nothing is collected but two figures a round; each round is cut by a checkpoint."""
    edges = edges.filter(F.col("src") != F.col("dst"))
    edges = common.gathered(edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), ONE_TASK)
    before = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("src", "dst"))).first()
        if state == before or not state[0]:
            ends = F.array(F.struct(F.col("src").alias("node"), F.col("dst").alias("label")), F.struct(F.col("dst").alias("node"), F.col("dst").alias("label")))
            return edges.select(F.explode(ends).alias("e")).select("e.node", "e.label").distinct()
        before = state
        few = state[0] <= ONE_TASK
        edges = common.gathered(_star(_star(_both(edges), True, few), False, few), ONE_TASK)
