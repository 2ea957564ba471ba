"""How keys fall on partitions, and how unevenly users act."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionforge.functions.partitioners import crc32_partition, murmur2_partition
from sessionforge.operators.running import PER_SLICE, running_max


def user_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))


def partition_loads(events: DataFrame, partitions: int = 6, partitioner=crc32_partition) -> DataFrame:
    """partition, events, users; partitions without a key appear with zero."""
    loads = user_counts(events).groupBy(partitioner(F.col("user_id"), partitions).alias("partition")).agg(F.sum("events").alias("events"), F.count(F.lit(1)).alias("users"))
    all_of = events.sparkSession.range(partitions).select(F.col("id").cast("int").alias("partition"))
    return all_of.join(loads, "partition", "left").select("partition", F.coalesce("events", F.lit(0)).alias("events"), F.coalesce("users", F.lit(0)).alias("users"))


def partition_skew(events: DataFrame, partitions: int = 6, partitioner=crc32_partition) -> DataFrame:
    """The busiest and the quietest partition over an even share."""
    even = F.sum("events") / partitions
    return partition_loads(events, partitions, partitioner).agg(F.round(F.try_divide(F.max("events"), even), 4).alias("busiest"), F.round(F.try_divide(F.min("events"), even), 4).alias("quietest"))


def disagreements(observed: DataFrame, partitions: int = 6, partitioner=crc32_partition) -> DataFrame:
    """One row over (user_id, partition) as a broker gave it: keys, how many disagree with the model, whether all agree, the first five that don't."""
    if observed.isEmpty():
        raise ValueError("nothing to compare")
    both = observed.select("user_id", F.col("partition").cast("int").alias("seen"), partitioner(F.col("user_id"), partitions).alias("model"))
    off = F.col("seen") != F.col("model")
    first = both.where(off).orderBy("user_id").limit(5).agg(F.sort_array(F.collect_list(F.struct("user_id", "seen", "model"))).alias("examples"))
    return both.agg(F.count(F.lit(1)).alias("keys"), F.count_if(off).alias("disagree"), F.countDistinct("seen").alias("partitions_seen"), F.countDistinct("model").alias("partitions_modelled")).withColumn("agrees", F.col("disagree") == 0).crossJoin(first)


def divergence(events: DataFrame, partitions: int = 6) -> DataFrame:
    """The share of keys that the two client models place differently, beside what chance would give."""
    keys = events.select("user_id").distinct()
    off = crc32_partition(F.col("user_id"), partitions) != murmur2_partition(F.col("user_id"), partitions)
    return keys.agg(F.count(F.lit(1)).alias("keys"), F.count_if(off).alias("differ"), F.round(F.try_divide(F.count_if(off), F.count(F.lit(1))), 4).alias("rate")).withColumn("expected", F.lit(round(1 - 1 / partitions, 4)))


def top_k_share(events: DataFrame, k: int = 50) -> DataFrame:
    """The share of events that the k busiest users hold; k beyond the users is all of them."""
    counts = user_counts(events)
    top = counts.orderBy(F.desc("events"), "user_id").limit(k).agg(F.sum("events").alias("top"), F.count(F.lit(1)).alias("k"))
    return counts.agg(F.sum("events").alias("all")).crossJoin(top).select("k", F.round(F.try_divide("top", "all"), 4).alias("share"))


def gap_misses(events: DataFrame, gap_s: float = 1800.0, per_slice: int = PER_SLICE) -> DataFrame:
    """Visits (first rows of a hint, in order of arrival) and those that the gap rule does not see.

    The rule compares with the user's newest event so far, so an older late one never moves it back.
    """
    rows = events.select("user_id", "session_hint", "event_id", F.unix_micros("ingest_ts").alias("i"), F.unix_micros("event_ts").alias("e"))
    seen = running_max(rows, ("i", "event_id"), "e", "user_id", per_slice)
    says_new = F.col("before").isNull() | (F.col("e") - F.col("before") > int(gap_s * 1e6))
    visits = seen.groupBy("user_id", "session_hint").agg(F.min_by(says_new, F.struct("i", "event_id")).alias("new"))
    return visits.agg(F.count(F.lit(1)).alias("visits"), F.count_if(~F.col("new")).alias("missed"), F.round(F.try_divide(F.count_if(~F.col("new")), F.count(F.lit(1))), 4).alias("miss_rate"))


def session_shape(events: DataFrame, conversion: str = "checkout") -> DataFrame:
    """Events a true session: nearest-index median and 95th percentile, shares of single-event and converting ones."""
    each = events.groupBy("session_hint").agg(F.count(F.lit(1)).alias("n"), F.max((F.col("event_type") == conversion).cast("int")).alias("won"))
    # The value at index floor(n * q) of the sorted sizes, from a histogram of sizes rather than one sorted array.
    sizes = each.groupBy("n").agg(F.count(F.lit(1)).alias("c"))
    run = F.sum("c").over(Window.orderBy("n"))
    total = F.sum("c").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    at = sizes.select("n", run.alias("run"), total.alias("total"))
    pick = lambda q: F.min(F.when(F.col("run") > F.floor(F.col("total") * q), F.col("n")))
    shares = each.agg(F.count(F.lit(1)).alias("sessions"), F.round(F.avg((F.col("n") == 1).cast("int")), 4).alias("single"), F.round(F.avg("won"), 4).alias("converting"))
    return at.agg(pick(0.5).alias("p50"), pick(0.95).alias("p95")).crossJoin(shares)


def event_mix(events: DataFrame) -> DataFrame:
    counts = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    return counts.crossJoin(counts.agg(F.sum("events").alias("all"))).select("event_type", "events", F.round(F.col("events") / F.col("all"), 4).alias("share"))
