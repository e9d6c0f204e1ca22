"""Connected components by alternating large-star and small-star steps, as joins and aggregates.

Both steps need, per node, only the least neighbour - an aggregate that is combined
before the shuffle - and one join that hands it back to the edges, which adaptive
execution splits where a hub has many. No neighbourhood is ever gathered.
"""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.runtime import cut

MAX_ROUNDS = 60


def release(frame: DataFrame) -> None:
    """Let Spark's cleaner remove the shuffles and checkpoints of frames that nothing refers to any more."""
    gc.collect()
    frame.sparkSession.sparkContext._jvm.System.gc()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is tied to the least of u and its neighbours."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b"), F.col("m").alias("a")).where("a < b").select("a", "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are tied to the least of them (edges come as a < b)."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    joined = edges.join(least, "b")
    out = joined.select(F.col("m").alias("x"), F.col("a").alias("y")).unionAll(least.select(F.col("m").alias("x"), F.col("b").alias("y")))
    return out.where("x < y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return tuple(row)


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each node's component, for every node with an edge.

    ``edges`` has long columns a and b; loops, repeats and either direction are fine.
    """
    now = cut(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    before = _print(now)
    for _ in range(MAX_ROUNDS):
        if before[0] == 0:
            break
        now = cut(_small_star(_large_star(now)))
        after = _print(now)
        release(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionAll(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
