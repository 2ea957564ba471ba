"""A stated query set against all rows, in blocks: each pair of a query block and a row block is one bounded task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ensure_importable, written


def usable(rows: DataFrame, *, zero: bool) -> DataFrame:
    """(vec_id, v) with v all finite doubles; one row for each vec_id (of several the smallest vector); ``zero`` keeps zero vectors."""
    v = F.col("embedding").cast("array<double>")
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    if not zero:
        ok &= F.exists(v, lambda x: x != 0)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ok).groupBy("vec_id").agg(F.min("v").alias("v"))


def top_of(rows: DataFrame, queries: DataFrame, search, score_type: str, k: int, row_block: int, query_block: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best over all row blocks.

    ``search(queries, rows)`` gets two Arrow tables (vec_id, v) and returns query_id, vec_id, score of its best k. Blocks are dealt by
    a hash of the id, so none is hot; each holds about ``row_block`` or ``query_block`` rows at any size of the tables.
    """
    ensure_importable(rows.sparkSession)
    rows = written(rows, "rows")
    queries = rows.where(queries)
    n, m = rows.count(), queries.count()
    if not n or not m:
        return rows.sparkSession.createDataFrame([], f"query_id long, rank int, vec_id long, score {score_type}")
    shards, blocks = -(-n // row_block), -(-m // query_block)
    each = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = queries.select("vec_id", "v", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), each(shards).alias("shard"))
    right = rows.select("vec_id", "v", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(shards)).cast("int").alias("shard"), each(blocks).alias("block"))

    def pair(a, b):
        return search(a.select(["vec_id", "v"]), b.select(["vec_id", "v"]))

    found = left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")).applyInArrow(pair, f"query_id long, vec_id long, score {score_type}")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def matrix(column):
    """A list column as a matrix; shorter vectors are filled with zeros."""
    import numpy as np

    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    width = int(sizes.max()) if len(sizes) else 0
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def same_width(a, b):
    import numpy as np

    d = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, d - x.shape[1]))) if x.shape[1] < d else x for x in (a, b))
