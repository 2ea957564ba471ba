"""Connected components by alternating large-star and small-star steps, in DataFrame operations only.

Each step hooks neighbours to the smallest neighbour and keeps all components as they are; it ends when every node hangs on
the smallest node of its component. A hub's neighbours are only ever grouped by a minimum (partial aggregates) and
joined with one row per hub, which AQE splits when the hub is hot. Every step ends in a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node of its component for every node of ``edges`` (a, b) but the roots themselves.

    Nodes may be of any type with an order. Null ends and loops are left out; repeated edges don't matter.
    """
    now = written(edges.where("a is not null and b is not null and a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = lambda t: t.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    seen = mark(now)
    for _ in range(rounds):
        if not seen.n:
            break
        before, now = now, written(_small_star(_large_star(now)), "edges")
        forget(before)
        last, seen = seen, mark(now)
        if last == seen:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
