"""Running maxima over an order that no task has to hold whole.

Rows are dealt by range to slices whose bounds follow row counts, whatever the times are like: a burst gets many slices, a quiet month shares one. Each
slice is put in order by itself, and what came before it is carried in from one row a slice (for groups: from the groups that reach over a slice's end, at most two rows a slice).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionforge.sources.files import staged

PER_SLICE = 1_000_000


def sliced(rows: DataFrame, order, per_slice: int = PER_SLICE) -> DataFrame:
    """``rows`` with ``slice``: about ``per_slice`` rows each, slice by slice in the order of the columns ``order``. Rows that are equal there stay together."""
    once = staged(rows, "rows")
    parts = math.ceil(once.count() / per_slice)
    if parts <= 1:
        return once.withColumn("slice", F.lit(0))
    # The bounds come from a sample, so the slices are written down before they are used twice.
    return staged(once.repartitionByRange(parts, *order).withColumn("slice", F.spark_partition_id()), "slices")


def running_max(rows: DataFrame, order, value: str, group: str | None = None, per_slice: int = PER_SLICE) -> DataFrame:
    """``rows`` with ``slice`` and ``before``: the largest ``value`` of the rows that come earlier in ``order`` (and have the same ``group``), null for the first."""
    cut = sliced(rows, [*([group] if group else []), *order], per_slice)
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    if group:
        # Slices follow the group first, so a group in several slices is the last of one and the first of the next.
        ends = cut.select("slice", F.struct(group).alias("g")).groupBy("slice").agg(F.min("g").alias("first"), F.max("g").alias("last"))
        over = ends.select("last").intersect(ends.select("first")).select(F.col(f"last.{group}").alias("over"))
        tops = cut.join(over, F.col(group).eqNullSafe(F.col("over")), "left_semi").groupBy("slice", group).agg(F.max(value).alias("top"))
        carried = tops.select(F.col("slice").alias("at"), F.col(group).alias("of"), F.max("top").over(earlier.partitionBy(group)).alias("carried"))
        joined = cut.join(carried, (F.col("slice") == F.col("at")) & F.col(group).eqNullSafe(F.col("of")), "left").drop("at", "of")
    else:
        tops = cut.groupBy("slice").agg(F.max(value).alias("top"))
        carried = tops.select(F.col("slice").alias("at"), F.max("top").over(earlier).alias("carried"))
        joined = cut.join(carried, F.col("slice") == F.col("at"), "left").drop("at")
    within = Window.partitionBy("slice", *([group] if group else [])).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return joined.withColumn("before", F.greatest("carried", F.max(value).over(within))).drop("carried")
