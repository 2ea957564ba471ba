"""Ingest and emission lag, session spans, the emission floor and the lag budget, each as a one-row DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionforge.functions.durations import seconds
from sessionforge.operators.scoring import attach
from sessionforge.schema import micros
from sessionforge.sources.files import staged

QUANTILES = (0.5, 0.95, 0.99)
#: Values are binned by 2**22 microseconds: a bin holds at most so many different values and a year has 7.5 million bins,
#: so no task of the quantiles grows with the number of rows.
BIN_BITS = 22


def histogram(rows: DataFrame, us: Column) -> DataFrame:
    """v, c: how often each value occurs, null included; counted before the shuffle, so a frequent value moves as one row a task.

    It is kept as a table, since what is read from it is read several times.
    """
    return staged(rows.groupBy(us.alias("v")).agg(F.count(F.lit(1)).alias("c")), "histogram")


def quantiles_of(counts: DataFrame, qs=QUANTILES) -> DataFrame:
    """rows and exact interpolated quantiles in seconds of a histogram of whole microseconds; an empty one gives rows = 0 and nulls.

    The bins that hold the wanted ranks are found first, at most two a quantile; only their values are then put in order.
    """
    if not qs:
        raise ValueError("no quantiles asked for")
    known = counts.where("v is not null").withColumn("bin", F.shiftright("v", BIN_BITS))
    every = Window.orderBy("bin")
    bins = known.groupBy("bin").agg(F.sum("c").alias("held")).select(
        "bin", (F.sum("held").over(every) - F.col("held")).alias("before"), "held",
        F.sum("held").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n"),
    )
    place = [(F.col("n") - 1) * F.lit(float(q)) for q in qs]
    ranks = [edge(x) for x in place for edge in (F.floor, F.ceil)]
    holds = reduce(lambda x, y: x | y, [(r >= F.col("before")) & (r < F.col("before") + F.col("held")) for r in ranks])
    wanted = F.broadcast(bins.where(holds).select("bin", "before", "n"))
    upto = F.col("before") + F.sum("c").over(Window.partitionBy("bin").orderBy("v"))
    at = known.join(wanted, "bin").select("v", "c", "n", upto.alias("upto"))
    value = lambda r: F.min(F.when((r < F.col("upto")) & (r >= F.col("upto") - F.col("c")), F.col("v")))
    each = []
    for i, x in enumerate(place):
        each += [value(F.floor(x)).alias(f"low{i}"), value(F.ceil(x)).alias(f"high{i}"), F.max(x - F.floor(x)).alias(f"part{i}")]
    got = at.agg(F.coalesce(F.max("n"), F.lit(0)).alias("rows"), *each)
    return got.select("rows", *[F.round((F.col(f"low{i}") + (F.col(f"high{i}") - F.col(f"low{i}")) * F.col(f"part{i}")) / 1e6, 4).alias(f"p{round(q * 100)}_s") for i, q in enumerate(qs)])


def quantiles(rows: DataFrame, us: Column, qs=QUANTILES) -> DataFrame:
    """rows and exact interpolated quantiles in seconds of a column of whole microseconds."""
    return quantiles_of(histogram(rows, us), qs)


def _counted(fits: Column) -> Column:
    """Rows of a histogram for which ``fits`` holds."""
    return F.coalesce(F.sum(F.when(fits, F.col("c"))), F.lit(0))


def _share(fits: Column) -> Column:
    return F.round(F.try_divide(_counted(fits), F.sum("c")), 4)


def _ingest(events: DataFrame) -> DataFrame:
    return histogram(events, micros(F.col("ingest_ts")) - micros(F.col("event_ts"))).where("v is not null")


def ingest_lag(events: DataFrame) -> DataFrame:
    lags = _ingest(events)
    more = lags.agg(F.round(F.max("v") / 1e6, 4).alias("max_s"), _counted(F.col("v") > 0).alias("late"), _share(F.col("v") > 0).alias("late_share"))
    return quantiles_of(lags).crossJoin(more)  # two single rows


def emission_lag(events: DataFrame, sessions: DataFrame, watermark: str = "2 minutes") -> DataFrame:
    """From an event to the earliest time its session can leave; events without a session are counted, not averaged."""
    lags = histogram(attach(events, sessions), micros(F.col("session_end")) + int(seconds(watermark) * 1e6) - micros(F.col("event_ts")))
    return quantiles_of(lags).crossJoin(lags.agg(_counted(F.col("v").isNull()).alias("unmatched")))


def session_span(sessions: DataFrame) -> DataFrame:
    return quantiles(sessions, F.round(F.col("duration_s") * 1e6).cast("long"))


def floor_check(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Least and largest time from a session's last event to its end: both must be the gap."""
    last = attach(events, sessions).where("session_end is not null").groupBy("user_id", "session_start").agg((F.max(micros(F.col("session_end"))) - F.max(micros(F.col("event_ts")))).alias("trailing"))
    return last.agg(F.round(F.min("trailing") / 1e6, 4).alias("least_s"), F.round(F.max("trailing") / 1e6, 4).alias("largest_s"))


def lag_budget(events: DataFrame, gap: str = "30 minutes", watermark: str = "2 minutes", batch_s: float = 0.0, goal_s: float = 60.0) -> DataFrame:
    """ingest, wait and batch terms with their shares, against the goal."""
    ingest = F.col("p50_s")
    wait = F.lit(seconds(gap) + seconds(watermark))
    total = ingest + wait + F.lit(batch_s)
    return quantiles(events.select((micros(F.col("ingest_ts")) - micros(F.col("event_ts"))).alias("lag")), F.col("lag"), (0.5,)).select(
        ingest.alias("ingest_s"), wait.alias("wait_s"), F.lit(batch_s).alias("batch_s"), total.alias("total_s"),
        *[F.round(F.try_divide(x, total), 4).alias(n) for n, x in (("ingest_share", ingest), ("wait_share", wait), ("batch_share", F.lit(batch_s)))],
        F.lit(goal_s).alias("goal_s"), F.round(total / goal_s, 4).alias("over_by"),
    )


def end_to_end(events: DataFrame, sessions: DataFrame, watermark: str = "2 minutes") -> DataFrame:
    """Quantiles of ingest lag plus emission lag summed event by event: medians of the terms don't add up to it."""
    joined = attach(events, sessions).where("session_end is not null")
    return quantiles(joined, micros(F.col("session_end")) + int(seconds(watermark) * 1e6) - 2 * micros(F.col("event_ts")) + micros(F.col("ingest_ts")))


def lateness_profile(events: DataFrame) -> DataFrame:
    late = _ingest(events).where("v > 0")
    return quantiles_of(late).crossJoin(late.agg(F.round(F.max("v") / 1e6, 4).alias("max_s"), _share(F.col("v") > 60_000_000).alias("over_60_s"), _share(F.col("v") > 300_000_000).alias("over_300_s")))
