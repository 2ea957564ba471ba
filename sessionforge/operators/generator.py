"""Synthetic clicks with planted lateness, copies, skew and true session ids: hashed draws over ranges, fully parallel.

Arrivals follow a Zipf law over users; each visit is generated on its own from hashes of (seed, user, visit), so a rerun of a lost task gives
the same rows. A user is never on the site twice: an arrival during a visit of the same user is deflected and makes that visit
longer. ``rate`` and ``pool`` set the think time, so about ``pool`` visits are open at a time as far as the population allows;
``statistics`` tells what was reached. Like a sequential simulation in distribution, not draw for draw.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Entry and listing pages, devices, countries.
REFERRERS, DEVICES, COUNTRIES = ("google", "newsletter", "social", None), ("mobile", "desktop", "tablet"), ("DE", "FR", "GB", "US", "JP", "BR")
LISTINGS = ("/", "/search", "/offers", "/new", "/category/home", "/category/garden")
# Chances of a checkout with a full cart and of a cart after a product page; shares of scrolls and clicks among the rest.
CHECKOUT, CART, SCROLL, CLICK = 0.35, 0.18, 0.30, 0.25


def uniform(seed: int, *of) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(F.lit(seed), *of), F.lit(1 << 53)) / float(1 << 53)


def normal(seed: int, *of) -> Column:
    u = F.greatest(uniform(seed, F.lit("a"), *of), F.lit(1e-12))
    return F.sqrt(-2 * F.log(u)) * F.cos(2 * math.pi * uniform(seed, F.lit("b"), *of))


def _one_of(values, seed: int, *of) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.floor(uniform(seed, *of) * len(values)) + 1).cast("int"))


def population(spark: SparkSession, users: int, alpha: float = 1.0, seed: int = 7) -> DataFrame:
    """user_id and weight; ids depend on their own seed alone."""
    ids = F.concat(F.lit("u_"), F.lpad(F.hex(F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 40))), 10, "0"))
    return spark.range(users).select(F.lower(ids).alias("user_id"), "id", F.pow(F.col("id") + 1.0, F.lit(-float(alpha))).alias("weight"))


def total_weight(users: int, alpha: float, head: int = 64) -> float:
    """The sum of i to the power -alpha for i from 1 to ``users``: the first terms one by one, the rest by Euler and Maclaurin to some ten digits."""
    m = min(users, head)
    first = math.fsum(i**-alpha for i in range(1, m + 1))
    area = math.log(users / m) if alpha == 1 else (users ** (1 - alpha) - m ** (1 - alpha)) / (1 - alpha)
    return first + area + (users**-alpha - m**-alpha) / 2 + alpha * (m ** (-alpha - 1) - users ** (-alpha - 1)) / 12


def _arrivals(people: DataFrame, total: Column, visits: float, seed: int) -> DataFrame:
    """id, user_id, visit: each user's share of the arrivals, the fraction by chance."""
    share = F.col("weight") / total * visits
    n = (F.floor(share) + (uniform(seed, F.lit("n"), "id") < share - F.floor(share)).cast("int")).cast("int")
    return people.withColumn("visit", F.explode(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))))


def visits(spark: SparkSession, *, rate: float, seconds: float, users: int, alpha: float, pool: int, visit_events: float, visit_sigma: float, seed: int, population_seed: int) -> DataFrame:
    """id, user_id, visit (in order of time), begin and end (microseconds from the start), size in events and how many arrivals were deflected to it."""
    if pool < 1 or visit_events < 1:
        raise ValueError("pool and visit_events must be 1 or more")
    if pool > users // 2:
        raise ValueError(f"a pool of {pool} is more than half of the population of {users}")
    people = population(spark, users, alpha, population_seed)
    total = F.lit(total_weight(users, alpha))
    mean = visit_events * math.exp(visit_sigma**2 / 2)
    each = _arrivals(people, total, rate * seconds / mean, seed)
    size = F.greatest(F.floor(F.exp(normal(seed, F.lit("size"), "id", "visit") * visit_sigma + math.log(visit_events))), F.lit(1)).cast("int")
    begin = F.floor(uniform(seed, F.lit("begin"), "id", "visit") * seconds * 1e6).cast("long")
    each = each.withColumn("size", size).withColumn("begin", begin).withColumn("end", F.col("begin") + (F.col("size") * (pool / rate * 1e6)).cast("long"))
    order = Window.partitionBy("id").orderBy("begin", "visit")
    busy = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    each = each.withColumn("first", (busy.isNull() | (F.col("begin") > busy)).cast("int")).withColumn("own", F.sum("first").over(order))
    own = each.groupBy("id", "user_id", F.col("own").cast("int").alias("visit")).agg(F.min("begin").alias("begin"), F.max("end").alias("end"), F.sum("size").cast("int").alias("size"), (F.count(F.lit(1)) - 1).alias("deflected"))
    return own.where(F.col("begin") < int(seconds * 1e6))


def _walk(s: Column, x: Column) -> Column:
    """The next event: a checkout needs a cart, a cart needs a product page; each choice has a draw of its own."""
    level = s["level"]  # 1: has seen a product, 2: has a cart, 3: has bought
    buys, fills = (level == 2) & (x["buy"] < CHECKOUT), (level == 1) & (x["fill"] < CART)
    scrolls, clicks = (x["u"] < SCROLL) & (x["k"] > 1), x["u"] < SCROLL + CLICK
    kind = F.when(buys, "checkout").when(fills, "add_to_cart").when(scrolls, "scroll").when(clicks, "click").otherwise("page_view")
    listing = F.element_at(F.array(*map(F.lit, LISTINGS)), (F.floor(x["page"] * len(LISTINGS)) + 1).cast("int"))
    product = F.concat(F.lit("/product/"), (F.floor(x["page"] * 9000) + 1000).cast("string"))
    page = F.when(kind == "checkout", "/checkout").when(kind == "add_to_cart", "/cart").when(kind == "scroll", s["page"]).when(kind == "click", product).otherwise(listing)
    now = F.when(buys, 3).when(fills, 2).when(kind == "click", F.greatest(level, F.lit(1))).otherwise(level)
    t = s["t"] + F.when(x["k"] > 1, x["wait"]).otherwise(F.lit(0).cast("long"))
    row = F.struct(x["k"].alias("k"), t.alias("t"), kind.alias("type"), page.alias("page"), F.when(x["k"] > 1, s["page"]).alias("referrer"))
    return F.struct(now.cast("int").alias("level"), t.alias("t"), page.alias("page"), F.concat(s["out"], F.array(row)).alias("out"))


def all_events(spark: SparkSession, *, rate: float = 100.0, seconds: float = 300.0, users: int = 5000, alpha: float = 1.0, pool: int = 150, visit_events: float = 6.0, visit_sigma: float = 0.9, late_rate: float = 0.05, late_median_s: float = 12.0, late_sigma: float = 1.4, dup_rate: float = 0.01, dup_delay_s: float = 3.0, start: str = "2024-01-01T00:00:00Z", seed: int = 7, population_seed: int = 7) -> DataFrame:
    """Events in the wire's columns, times as timestamps, with ``copy`` and ``pending``: copies due after the end of the run are pending and not sent."""
    visit = visits(spark, rate=rate, seconds=seconds, users=users, alpha=alpha, pool=pool, visit_events=visit_events, visit_sigma=visit_sigma, seed=seed, population_seed=population_seed)
    draw = lambda what, k: uniform(seed, F.lit(what), "id", "visit", k)
    wait = lambda k: F.floor(-F.log(F.greatest(draw("gap", k), F.lit(1e-9))) * (pool / rate * 1e6)).cast("long")
    steps = F.transform(F.sequence(F.lit(1), F.col("size")), lambda k: F.struct(k.alias("k"), draw("buy", k).alias("buy"), draw("fill", k).alias("fill"), draw("kind", k).alias("u"), draw("page", k).alias("page"), wait(k).alias("wait")))
    begin = F.struct(F.lit(0).alias("level"), F.lit(0).cast("long").alias("t"), F.lit("/").alias("page"), F.array().cast("array<struct<k:int,t:bigint,type:string,page:string,referrer:string>>").alias("out"))
    made = visit.withColumn("row", F.explode(F.aggregate(steps, begin, _walk, lambda s: s["out"]))).where(F.col("begin") + F.col("row.t") < int(seconds * 1e6))
    at = F.unix_micros(F.lit(start).cast("timestamp")) + F.col("begin") + F.col("row.t")
    key = ("id", "visit", "row.k")
    lag = F.when(uniform(seed, F.lit("late"), *key) < late_rate, F.exp(normal(seed, F.lit("lag"), *key) * late_sigma + math.log(late_median_s))).otherwise(0.0)
    sent = made.select(
        F.lower(F.hex(F.xxhash64(F.lit(seed), *key))).alias("event_id"), "user_id", F.concat_ws("_", F.lit("s"), F.substring("user_id", 3, 20), F.lpad(F.col("visit").cast("string"), 3, "0")).alias("session_hint"),
        F.col("row.type").alias("event_type"), F.col("row.page").alias("page"), F.coalesce("row.referrer", _one_of(REFERRERS, seed, F.lit("ref"), "id", "visit")).alias("referrer"),
        _one_of(DEVICES, seed, F.lit("dev"), "id", "visit").alias("device"), _one_of(COUNTRIES, seed, F.lit("land"), "id").alias("country"),
        F.timestamp_micros(at - at % 1000).alias("event_ts"), F.timestamp_micros(F.floor((at + lag * 1e6) / 1000).cast("long") * 1000).alias("ingest_ts"),
    )
    end = F.lit(start).cast("timestamp") + F.make_interval(secs=F.lit(float(seconds)))
    copies = sent.where(uniform(seed, F.lit("dup"), "event_id") < dup_rate).withColumn("ingest_ts", F.timestamp_micros(F.unix_micros("ingest_ts") + int(dup_delay_s * 1e6)))
    both = sent.withColumn("copy", F.lit(False)).unionByName(copies.withColumn("copy", F.lit(True)))
    return both.withColumn("pending", F.col("copy") & (F.col("ingest_ts") > end))


def events(spark: SparkSession, **how) -> DataFrame:
    """What is sent; ``how`` as for ``all_events``."""
    return all_events(spark, **how).where("not pending").drop("copy", "pending")


def statistics(made: DataFrame, top: int = 50) -> DataFrame:
    """One row over ``all_events``: how much of everything, lateness by nearest index among late events, the share of the busiest users, mean open visits."""
    late = F.unix_micros("ingest_ts") - F.unix_micros("event_ts")
    once = made.where("not copy")
    counts = made.agg(F.count_if(~F.col("pending")).alias("emitted"), F.count_if(~F.col("copy")).alias("originals"), F.count_if(F.col("copy") & ~F.col("pending")).alias("duplicates"), F.count_if("pending").alias("duplicates_pending"))
    ranked = once.where(late > 0).groupBy(late.alias("v")).agg(F.count(F.lit(1)).alias("c")).select("v", F.sum("c").over(Window.orderBy("v")).alias("upto"))
    n = F.max("upto").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    pick = lambda q: F.round(F.min(F.when(F.col("upto") > F.floor(F.col("n") * q), F.col("v"))) / 1e6, 3)
    lateness = ranked.select("v", "upto", n.alias("n")).agg(F.coalesce(F.max("n"), F.lit(0)).alias("late_events"), pick(0.5).alias("lateness_p50_s"), pick(0.95).alias("lateness_p95_s"), F.round(F.max("v") / 1e6, 3).alias("lateness_max_s"))
    users = once.groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))
    busiest = users.orderBy(F.desc("events"), "user_id").limit(top).agg(F.sum("events").alias("top_events"))
    shares = users.agg(F.count(F.lit(1)).alias("distinct_users"), F.sum("events").alias("of")).crossJoin(busiest).select("distinct_users", F.round(F.try_divide("top_events", "of"), 4).alias("top_share"))
    open_us = F.unix_micros(F.max("event_ts")) - F.unix_micros(F.min("event_ts"))
    by_visit = once.groupBy("session_hint").agg(open_us.alias("open"), F.min("event_ts").alias("a"), F.max("event_ts").alias("b"))
    span = F.unix_micros(F.max("b")) - F.unix_micros(F.min("a"))
    held = by_visit.agg(F.count(F.lit(1)).alias("visits"), F.round(F.try_divide(F.sum("open"), span), 2).alias("mean_occupancy"))
    return counts.crossJoin(lateness).crossJoin(shares).crossJoin(held)  # single rows
