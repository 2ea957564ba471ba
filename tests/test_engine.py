"""The engine's own operators on small hand-made rows, and every registered query against its SQL."""

import datetime as dt
import json
import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sessionforge import catalog
from sessionforge.functions import durations
from sessionforge.functions.partitioners import crc32_partition, murmur2_partition
from sessionforge.operators import digests, generator, latency, partitions, running, scoring, sessions, upsert
from sessionforge.plans import repro, sweeps
from sessionforge.schema import parse, parse_failures, quarantine
from sessionforge.sources.files import Files, read_file_stream, staged
from sessionforge.streaming import job, progress, recovery

T0 = dt.datetime(2024, 1, 1)


def clicks(spark, rows):
    """rows: (event_id, user, seconds, page, type[, hint, lag])."""
    full = [(r[0], r[1], T0 + dt.timedelta(seconds=r[2]), r[3], r[4], r[5] if len(r) > 5 else "h", T0 + dt.timedelta(seconds=r[2] + (r[6] if len(r) > 6 else 0))) for r in rows]
    return spark.createDataFrame(full, "event_id string, user_id string, event_ts timestamp, page string, event_type string, session_hint string, ingest_ts timestamp")


@pytest.mark.parametrize("seconds, n", [((0, 600), 1), ((0, 1800), 1), ((0, 1801), 2), ((600, 300, 0), 1)])
def test_gap_boundary(spark, seconds, n):
    rows = clicks(spark, [(str(i), "u", s, "/", "click") for i, s in enumerate(seconds)])
    assert sessions.sessions(rows).count() == n


def test_features(spark):
    rows = clicks(spark, [("1", "a", 0, "/", "view"), ("2", "a", 10, "/", "checkout"), ("3", "a", 20, "/p/1", "view"), ("4", "b", 0, None, "view"), ("5", "c", 5, "/", "view")])
    got = {r.user_id: r for r in sessions.build_batch(rows).collect()}
    a = got["a"]
    assert (a.event_count, a.page_depth, a.duration_s, a.converted, a.bounce, a.window_span_s) == (3, 2, 20.0, 1, 0, 1820.0)
    assert (got["b"].page_depth, got["b"].bounce, got["c"].bounce) == (0, 0, 1)


def test_dedupe_keeps_the_first_arrival_and_restamped_copies(spark):
    rows = clicks(spark, [("1", "a", 0, "/", "view"), ("1", "a", 300, "/x", "view", "h", 9), ("2", "b", 0, "/", "view"), ("2", "c", 0, "/", "view", "h", 5)])
    got = {(r.event_id, r.user_id) for r in sessions.dedupe(rows).collect()}
    assert got == {("1", "a"), ("2", "b")}
    with pytest.raises(ValueError):
        sessions.dedupe_streaming(rows)


def test_parse_bad_rows(spark):
    lines = ['{"event_id":"1","user_id":"u","event_ts":"2024-01-01T00:00:00.000Z","ingest_ts":"2024-01-01T00:00:01.500Z"}', '{"event_id":"2","user_id":"u","event_ts":"15/08/2026 12:00:00","ingest_ts":"2024-01-01T00:00:01Z"}', "not json", None]
    got = parse(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert got.count() == 4 and parse_failures(got).count() == 3
    assert got.where("event_id = '1'").first().lateness_s == 1.5
    usable, refused = quarantine(got)
    assert (usable.count(), refused.count()) == (1, 3)


def test_scorecard_merge_split_unmatched(spark):
    rows = clicks(spark, [("1", "a", 0, "/", "v", "x"), ("2", "a", 60, "/", "v", "y"), ("3", "a", 9000, "/", "v", "y"), ("4", "z", 0, "/", "v", "q")])
    built = sessions.sessions(rows.where("user_id = 'a'"))
    r = scoring.scorecard(rows, built).first()
    assert (r.events_joined, r.unmatched, r.true_sessions, r.true_scored, r.recovered, r.merged, r.boundaries_lost, r.split) == (4, 1, 3, 2, 2, 1, 1, 1)
    assert (r.boundary_miss_rate, r.split_rate) == (0.5, 0.5)
    assert scoring.overlaps(built).count() == 0
    empty = scoring.scorecard(rows.limit(0), built.limit(0)).first()
    assert (empty.boundaries_lost, empty.split_rate) == (0, 0.0)


def test_half_open_windows(spark):
    rows = clicks(spark, [("1", "a", 1800, "/", "v")])
    windows = spark.createDataFrame([("a", T0, T0 + dt.timedelta(seconds=1800)), ("a", T0 + dt.timedelta(seconds=1800), T0 + dt.timedelta(seconds=3600))], "user_id string, session_start timestamp, session_end timestamp")
    assert [r.session_start for r in scoring.attach(rows, windows).collect()] == [T0 + dt.timedelta(seconds=1800)]


def _uneven(spark, n=20_000, days=30):
    """Half of all events by one user over a month, the rest by a thousand; a burst of a tenth of them in one minute."""
    hot = F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), (F.col("id") % 1000).cast("string")))
    at = F.when(F.col("id") % 10 == 0, F.pmod(F.xxhash64("id"), F.lit(60_000_000))).otherwise(F.pmod(F.xxhash64("id"), F.lit(days * 86_400_000_000))) + 1_704_067_200_000_000
    e = spark.range(n).select(F.col("id").cast("string").alias("event_id"), hot.alias("user_id"), F.timestamp_micros(at).alias("event_ts"), F.concat(F.lit("/p"), (F.col("id") % 7).cast("string")).alias("page"), F.lit("view").alias("event_type"), F.concat(hot, (at / 7_200_000_000).cast("int").cast("string")).alias("session_hint"))
    return e.withColumn("ingest_ts", F.timestamp_micros(F.unix_micros("event_ts") + F.when(F.col("event_id").cast("long") % 9 == 0, 3_600_000_000).otherwise(0)))


@pytest.fixture
def plain_joins(spark):
    """No broadcasts and no plan of its own at run time: what a task gets is what the keys give it."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    for k, v in zip(held, ("false", "-1", "16"), strict=True):
        spark.conf.set(k, v)
    yield
    for k, v in held.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("gap, piece", [("30 minutes", "1 hour"), ("2 hours", "1 hour"), ("1 day", "10 minutes"), ("1 second", "7 days")])
def test_sessions_in_two_levels_equal_those_in_one(spark, gap, piece):
    rows = _uneven(spark, 4000)
    one, two = sessions.sessions(rows, gap, "view"), sessions.split_sessions(rows, gap, "view", piece)
    assert one.exceptAll(two.select(one.columns)).count() == 0 and one.count() == two.count()


def test_stitched_sessions_merge_their_page_sets(spark):
    rows = clicks(spark, [("1", "a", 3590, "/", "view"), ("2", "a", 3610, "/", "checkout"), ("3", "a", 3620, "/x", "view"), ("4", "a", 5399, None, "view"), ("5", "a", 7199, "/y", "view"), ("6", "a", 9000, "/z", "view")])
    got = sorted((r.event_count, r.page_depth, r.converted, r.bounce, r.duration_s) for r in sessions.split_sessions(rows).collect())
    assert got == [(1, 1, 0, 1, 0.0), (5, 3, 1, 0, 3609.0)]


def test_a_hot_user_fills_no_task(spark, plain_joins):
    rows = staged(_uneven(spark), "uneven")
    built = staged(sessions.split_sessions(rows, "30 minutes"), "built")
    joined = scoring.attach(rows, built)
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 0.25 * sum(sizes)  # by user it was over half
    plain = rows.join(built.withColumnRenamed("user_id", "o"), (F.col("o") == F.col("user_id")) & (F.col("event_ts") >= F.col("session_start")) & (F.col("event_ts") < F.col("session_end")), "left").select(*rows.columns, "session_start", "session_end")
    assert joined.select(plain.columns).exceptAll(plain).count() == 0 and plain.count() == 20_000
    pieces = rows.groupBy("user_id", F.expr("unix_micros(event_ts) div 3600000000")).count()
    assert pieces.agg(F.max("count")).first()[0] < 0.15 * 20_000


@pytest.mark.parametrize("per_slice", [700, 10**6])
def test_running_maxima_by_slices(spark, per_slice):
    from pyspark.sql import Window

    rows = staged(_uneven(spark), "uneven").select("event_id", "user_id", F.unix_micros("ingest_ts").alias("i"), F.unix_micros("event_ts").alias("e"))
    rows = rows.union(rows.where("event_id = '4'").withColumn("user_id", F.lit(None).cast("string")))
    for group in (None, "user_id"):
        got = running.running_max(rows, ("i", "event_id", "e"), "e", group, per_slice)
        w = Window.partitionBy(*([group] if group else [])).orderBy("i", "event_id", "e").rowsBetween(Window.unboundedPreceding, -1)
        want = rows.withColumn("before", F.max("e").over(w))
        assert got.select(want.columns).exceptAll(want).count() == 0 and got.count() == want.count()
        sizes = [r["count"] for r in got.groupBy("slice").count().collect()]
        assert max(sizes) <= 2 * per_slice and (len(sizes) == 1) == (per_slice > 20_001)


def test_latency(spark):
    rows = clicks(spark, [("1", "a", 0, "/", "v", "h", 0), ("2", "a", 10, "/", "v", "h", 10), ("3", "a", 20, "/", "v", "h", 100), ("4", "a", 30, "/", "v", "h", 5)])
    r = latency.ingest_lag(rows).first()
    assert (r.rows, r.late, r.max_s, r.p50_s, r.late_share) == (4, 3, 100.0, 7.5, 0.75)
    assert r.p95_s == pytest.approx(np.quantile([0, 10, 100, 5], 0.95))
    f = latency.floor_check(rows, sessions.sessions(rows)).first()
    assert (f.least_s, f.largest_s) == (1800.0, 1800.0)
    assert latency.quantiles(rows.limit(0), F.unix_micros("event_ts")).first().rows == 0
    with pytest.raises(ValueError):
        latency.quantiles(rows, F.lit(1), ())


def test_quantiles_are_exact(spark):
    rng = np.random.default_rng(5)
    # Many bins, few bins, ties, negative values, one value.
    for values in (rng.integers(-(10**9), 10**11, 501), rng.integers(0, 1000, 400), np.repeat([7_000_000, -3_000_000], 50), np.array([5])):
        rows = spark.createDataFrame([(int(v),) for v in values] + [(None,)], "x long")
        r = latency.quantiles(rows, F.col("x"), (0.01, 0.5, 0.99, 1.0)).first()
        assert r.rows == len(values)
        assert [r.p1_s, r.p50_s, r.p99_s, r.p100_s] == pytest.approx((np.quantile(values, (0.01, 0.5, 0.99, 1.0)) / 1e6).tolist(), abs=2e-4)
    plan = latency.quantiles(rows, F.col("x"))._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan  # no task holds all values
    assert latency.emission_lag(clicks(spark, []), sessions.sessions(clicks(spark, []))).first().asDict() == {"rows": 0, "p50_s": None, "p95_s": None, "p99_s": None, "unmatched": 0}


def test_durations():
    assert durations.seconds("30 minutes") == 1800 and durations.emission_floor("30 minutes", "2 minutes") == 1920
    for bad in ("30", "", "30minutes", "3 fortnights"):
        with pytest.raises(ValueError):
            durations.seconds(bad)
    for bad in (30, None, []):
        with pytest.raises(TypeError):
            durations.seconds(bad)


def test_partitioner_goldens(spark):
    # Key, CRC-32 partition, murmur2 partition of six, as brokers gave them.
    gold = [("u_004ae5", 2, 1), ("u_03983c", 3, 2), ("u_0870e1", 3, 4), ("u_09e469", 3, 1), ("u_0a5d2f", 0, 2), ("u_0ff18e", 5, 4), ("u_101fbc", 4, 2), ("u_11af92", 5, 1)]
    rows = spark.createDataFrame(gold, "user_id string, a int, b int")
    assert rows.where((crc32_partition(F.col("user_id"), 6) != F.col("a")) | (murmur2_partition(F.col("user_id"), 6) != F.col("b"))).count() == 0
    short = spark.createDataFrame([("",), ("a",), ("é",), ("abcde",)], "k string")
    assert short.where(murmur2_partition(F.col("k"), 6).isNull()).count() == 0
    r = partitions.disagreements(rows.select("user_id", F.col("a").alias("partition"))).first()
    assert r.agrees and r.disagree == 0
    with pytest.raises(ValueError):
        partitions.disagreements(rows.select("user_id", F.col("a").alias("partition")).limit(0))
    assert partitions.partition_loads(clicks(spark, [("1", "u", 0, "/", "v")]), 6).count() == 6


def test_upsert_replay_drift(spark, tmp_path):
    rows = sessions.sessions(clicks(spark, [("1", "a", 0, "/", "v"), ("2", "b", 0, "/", "v")]))
    table = upsert.SessionTable(spark, f"file://{tmp_path}/t", rows.schema)
    assert table.apply(rows, "q", 0) == {"inserted": 2, "updated": 0, "rows": 2}
    before = upsert.fingerprint(table.read()).first()[0]
    assert table.apply(rows.repartition(3), "q", 0)["updated"] == 2
    assert upsert.fingerprint(table.read()).first()[0] == before
    changed = table.apply(rows.where("user_id = 'a'").withColumn("event_count", F.lit(9).cast("long")), "q", 1)
    after = upsert.fingerprint(table.read()).first()[0]
    assert changed["rows"] == 2 and recovery.compare(before, after) == "cells_differ"
    with pytest.raises(upsert.DuplicateKeys):
        table.apply(rows.union(rows), "q", 2)
    assert table.current()["batchId"] == 1
    assert table.apply(rows.limit(0), "q", 2)["rows"] == 2
    table.refuse_drift(2, "q")
    table.refuse_drift(None, "other")
    for batch, query in ((3, "q"), (2, "other")):
        with pytest.raises(upsert.Drift):
            table.refuse_drift(batch, query)


def _sessions_of(spark, n, days, count=1):
    """n sessions over some days, one user each."""
    at = F.timestamp_micros((F.col("id") % days) * 86_400_000_000 + F.col("id") * 1_000_000 + 1_704_067_200_000_000)
    cols = [F.concat(F.lit("u"), F.col("id").cast("string")).alias("user_id"), at.alias("session_start"), F.timestamp_micros(F.unix_micros(at) + 1_800_000_000).alias("session_end"), F.lit(count).cast("long").alias("event_count")]
    return spark.range(n).select(*cols, F.lit(1).cast("long").alias("page_depth"), F.rand(1).alias("duration_s"), F.lit(0).alias("converted"), F.lit(0).alias("bounce"), F.lit(1800.0).alias("window_span_s"))


def _bytes(table):
    return sum(table.files.size(f"data/{run}") for run in table.files.names("data"))


def _live(table):
    return {r["run"] for p in table.pointers() for runs in table._pointer(p)["days"].values() for r in runs}


def test_upsert_writes_as_much_as_the_batch_holds(spark, tmp_path):
    rows = _sessions_of(spark, 100_000, 50).coalesce(2)
    table = upsert.SessionTable(spark, f"file://{tmp_path}/t", rows.schema)
    table.apply(rows, "q", 0)
    before, runs = _bytes(table), set(table.files.names("data"))
    one_day = rows.where("unix_micros(session_start) div 86400000000 = 19725").coalesce(1).limit(1000).withColumn("event_count", F.lit(7).cast("long"))
    assert table.apply(one_day, "q", 1) == {"inserted": 0, "updated": 1000, "rows": 100_000}
    (new,) = set(table.files.names("data")) - runs
    assert table.files.size(f"data/{new}") < 0.02 * before and table.files.names(f"data/{new}") == ["_SUCCESS", "day=19725"]
    assert table.read().where("event_count = 7").count() == 1000 and table.read().count() == 100_000
    plan = table.read()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and len(table.current()["days"]) == 51  # only the day of two runs is merged


def test_upsert_equals_a_dict_after_many_batches(spark, tmp_path):
    rng, kind = random.Random(7), "user_id string, session_start timestamp, event_count long"
    table = upsert.SessionTable(spark, f"file://{tmp_path}/t", spark.createDataFrame([], kind).schema)
    model, most = {}, 0
    for b in range(50):
        batch = {(f"u{rng.randint(0, 30)}", T0 + dt.timedelta(days=b // 10 - rng.randint(0, 2), hours=rng.randint(0, 3))): rng.randint(0, 99) for _ in range(rng.randint(0, 12))}
        got = table.apply(spark.createDataFrame([(*k, v) for k, v in batch.items()], kind).coalesce(1), "q", b)
        assert got == {"inserted": len(batch.keys() - model.keys()), "updated": len(batch.keys() & model.keys()), "rows": len(model | batch)}
        model |= batch
        most = max(most, *map(len, table.current()["days"].values()), 0)
    assert {(r.user_id, r.session_start): r.event_count for r in table.read().collect()} == model
    assert table.read().count() == len(model) and most <= 2 * table.FAN and len(table.files.names("pointers")) == 2
    assert set(table.files.names("data")) == _live(table)


@pytest.mark.parametrize("step", ["_write", "_point", "_compact", "_tidy"])
def test_upsert_survives_a_crash_at_any_step(spark, tmp_path, monkeypatch, step):
    rows = _sessions_of(spark, 9, 1)
    table = upsert.SessionTable(spark, f"file://{tmp_path}/t", rows.schema)
    for b in range(3):
        table.apply(rows.where(f"event_count + substr(user_id, 2) <= {b + 3}").withColumn("event_count", F.lit(b).cast("long")), "q", b)
    before = upsert.fingerprint(table.read()).first()[0]

    def dies(*a):
        raise OSError("no more")

    with monkeypatch.context() as m:
        m.setattr(table, step, dies)
        with pytest.raises(OSError):
            table.apply(rows, "q", 3)
    again = upsert.SessionTable(spark, f"file://{tmp_path}/t", rows.schema)
    if step in ("_write", "_point"):
        assert upsert.fingerprint(again.read()).first()[0] == before
    assert again.apply(rows, "q", 3)["rows"] == 9 and again.read().drop("loaded_at").exceptAll(rows.select(again.read().drop("loaded_at").columns)).count() == 0


def test_upsert_survives_a_crash_inside_compaction(spark, tmp_path, monkeypatch):
    rows = _sessions_of(spark, 6, 1)
    table = upsert.SessionTable(spark, f"file://{tmp_path}/t", rows.schema)
    for b in range(table.FAN - 1):
        table.apply(rows.withColumn("event_count", F.lit(b).cast("long")), "q", b)
    point, calls = table._point, []

    def second_dies(pointer):
        calls.append(pointer["n"])
        if len(calls) == 2:
            raise OSError("no more")
        point(pointer)

    with monkeypatch.context() as m:
        m.setattr(table, "_point", second_dies)
        with pytest.raises(OSError):
            table.apply(rows.withColumn("event_count", F.lit(70).cast("long")), "q", 3)
    assert [r.event_count for r in table.read().collect()] == [70] * 6 and table.current()["batchId"] == 3
    table.ORPHAN_S = -1  # as if a day had gone by
    table.apply(rows.withColumn("event_count", F.lit(71).cast("long")), "q", 4)
    assert [r.event_count for r in table.read().collect()] == [71] * 6
    assert len(next(iter(table.current()["days"].values()))) == 1 and set(table.files.names("data")) == _live(table)


def test_sql_functions(spark):
    from sessionforge.functions import sql

    sql.register(spark)
    keys = spark.createDataFrame([(k,) for k in ("", "a", "é", "abc", "abcd", "abcde", "u_004ae5", None)], "k string")
    keys.createOrReplaceTempView("keys_of_test")
    got = spark.sql("select k, murmur2_partition(k, 6) as m, crc32_partition(k, 6) as c from keys_of_test")
    want = keys.select("k", murmur2_partition(F.col("k"), 6).alias("m"), crc32_partition(F.col("k"), 6).alias("c"))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    assert spark.sql("select duration_seconds('1.5 hours') as a, emission_floor('30 minutes', '2 minutes') as b").first() == (5400.0, durations.emission_floor("30 minutes", "2 minutes"))
    with pytest.raises(Exception, match="not a duration"):
        spark.sql("select duration_seconds('3 fortnights')").collect()
    clicks(spark, [("1", "a", 0, "/", "won"), ("2", "a", 1800, "/", "view"), ("3", "a", 3601, "/x", "view")]).createOrReplaceTempView("events_of_test")
    sql.register_sessions(spark, "events_of_test", "my_sessions")
    assert sorted((r.event_count, r.converted, r.bounce, r.window_span_s) for r in spark.sql("select * from my_sessions('30 minutes', 'won')").collect()) == [(1, 0, 1, 1800.0), (2, 1, 0, 3600.0)]


def test_upsert_lets_one_of_two_writers_win(spark, tmp_path, monkeypatch):
    rows = _sessions_of(spark, 4, 1)
    one, two = (upsert.SessionTable(spark, f"file://{tmp_path}/t", rows.schema) for _ in range(2))
    one.apply(rows, "q", 0)
    stale = two.current(), two.pointers()
    one.apply(rows.withColumn("event_count", F.lit(5).cast("long")), "q", 1)
    with monkeypatch.context() as m:
        m.setattr(two, "current", lambda: stale[0])
        m.setattr(two, "pointers", lambda: stale[1])
        with pytest.raises(upsert.Conflict):
            two.apply(rows.withColumn("event_count", F.lit(6).cast("long")), "q", 1)
    assert {r.event_count for r in one.read().collect()} == {5} and len(one.files.names("data")) == 2
    # A pointer that is being written stops others; one that its writer left unfinished doesn't count.
    (tmp_path / "t" / "pointers" / "9").write_text('{"n": 9, "par')
    with pytest.raises(upsert.Conflict):
        two.apply(rows, "q", 2)
    two.TORN_S = one.TORN_S = -1
    assert two.apply(rows, "q", 2)["updated"] == 4 and two.current()["n"] == 10 and two.current()["parent"] == 2
    two.apply(rows, "q", 3)
    assert two.files.names("pointers") == ["11", "12"] and {r.event_count for r in one.read().collect()} == {1}  # four runs have become one


def test_fingerprint_follows_the_rows(spark):
    rows = sessions.sessions(clicks(spark, [(str(i), f"u{i}", 0, "/", "v") for i in range(60)]))
    assert upsert.fingerprint(rows.repartition(5)).first() == upsert.fingerprint(rows).first()
    assert upsert.fingerprint(rows.withColumn("event_count", F.col("event_count") + (F.col("user_id") == "u7").cast("int"))).first() != upsert.fingerprint(rows).first()
    assert upsert.fingerprint(rows.limit(0)).first()[0].startswith("0:")
    plan = upsert.fingerprint(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "MergingSessions" not in plan  # the leaves were kept after one pass


def test_differing_keys_descends_along_unlike_nodes(spark, monkeypatch):
    rows = staged(_sessions_of(spark, 3000, 9), "rows")
    key = ("user_id", "session_start")
    other = rows.where("user_id != 'u5'").withColumn("event_count", F.when(F.col("user_id") == "u77", 9).otherwise(F.col("event_count"))).unionByName(rows.where("user_id = 'u6'").withColumn("user_id", F.lit("new")))
    assert {(r.user_id, r.side) for r in digests.differing_keys(rows, other, key).collect()} == {("u5", "left"), ("u77", "both"), ("new", "right")}
    a, b = (digests.tree(digests.leaves(x, key)) for x in (rows, other))
    assert len(digests.unlike(a, b)) == 3 and digests.unlike(a, a) == []
    assert digests.differing_keys(rows, rows.repartition(7), key).count() == 0
    assert digests.differing_keys(rows.limit(0), rows, key).count() == 3000
    nulls = rows.withColumn("event_count", F.lit(None).cast("long"))
    assert digests.differing_keys(rows, nulls, key).where("side = 'both'").count() == 3000


def test_table_keeps_its_tree_and_reads_changed_days_only(spark, tmp_path, monkeypatch):
    rows = _sessions_of(spark, 500, 5)
    table = upsert.SessionTable(spark, f"file://{tmp_path}/t", rows.schema)
    root = lambda t: t.where("level = 0").select("rows", "digest").first()
    fresh = lambda: root(digests.tree(digests.leaves(table.read(), table.key)))
    assert root(table.tree())["rows"] == 0
    table.apply(rows, "q", 0)
    assert root(table.tree()) == fresh()
    read, newest = [], table._newest
    monkeypatch.setattr(table, "_newest", lambda days: read.append(sorted(days)) or newest(days))
    table.tree()
    table.apply(rows.where("user_id = 'u7'").withColumn("event_count", F.lit(4).cast("long")), "q", 1)
    got = root(table.tree())
    assert read == [[], ["19725"]] and got == fresh()
    table.apply(rows.limit(0), "q", 2)
    assert root(table.tree()) == got and len(table.files.names("trees")) <= 2 and len(table.files.names("leaves")) <= 2


def test_crash_points():
    seen = []
    with pytest.raises(ValueError):
        job.Stopping(lambda r, b: None, 0, "midway")
    for point, n in (("before-merge", 0), ("after-merge", 1)):
        seen.clear()
        sink = job.Stopping(lambda r, b: seen.append(b), 0, point)
        with pytest.raises(job.PlannedStop):
            sink(None, 0)
        assert len(seen) == n
        sink(None, 1)
        assert len(seen) == n + 1


def test_replay_arms(spark, sf, tmp_path):
    folder = catalog._shards(spark, sf)
    raw = lambda: read_file_stream(spark, folder, 2)
    arms = [sweeps.replay_arm(spark, raw, f"file://{tmp_path}/{a}", a, batch=1, gap="6 hours") for a in ("clean", "crash-after", "crash-before", "fresh-checkpoint")]
    said = {r["arm"]: r["verdict"] for r in sweeps.replay_report(arms)}
    assert said == {"clean": "identical", "crash-after": "identical", "crash-before": "identical", "fresh-checkpoint": "identical", "wiped-table": "NOT RUN"}
    assert next(a for a in arms if a["arm"] == "crash-after")["redone"] == [1] and isinstance(arms[1]["added"], list)
    with pytest.raises(upsert.Drift):
        sweeps.replay_arm(spark, raw, f"file://{tmp_path}/w", "wiped-table", gap="6 hours")


def _checkpoint(spark, at, planned, committed, line='{"t":{"0":5}}'):
    for log, names in (("offsets", planned), ("commits", committed)):
        for n in names:
            Files(spark, f"{at}/{log}").write(str(n), f"v1\n{{}}\n{line}")
    return at


def test_checkpoint_reading(spark, tmp_path):
    at = _checkpoint(spark, f"file://{tmp_path}/cp", range(3), range(2))
    r = recovery.checkpoint_state(spark, at).first()
    assert (r.last_planned, r.last_committed, r.uncommitted, r.next_batch) == (2, 1, [2], 2)
    whole = recovery.checkpoint_state(spark, _checkpoint(spark, f"file://{tmp_path}/whole", range(4), range(4))).first()
    assert (whole.uncommitted, whole.next_batch) == ([], 4)
    gap = recovery.checkpoint_state(spark, _checkpoint(spark, f"file://{tmp_path}/gap", range(4), (0, 2, 3))).first()
    assert (gap.uncommitted, gap.next_batch) == ([1], 1)
    assert recovery.source_offsets(spark, at).count() == 3 and recovery.source_offsets(spark, at, 2).first().offset == '{"t":{"0":5}}'
    bare = _checkpoint(spark, f"file://{tmp_path}/bare", [0], [], "17")
    assert recovery.source_offsets(spark, bare).first().offset == "17"
    assert recovery.kafka_position('{"t":{"0":5}}') == {"t:0": 5}
    assert recovery.replay_scope({"last_planned": 3, "last_committed": 2, "uncommitted": [3], "next_batch": 3}, {"last_committed": 5}) == {"redone": [3], "added": [4, 5], "resumed_at": 3, "finished_at": 5}
    assert recovery.kafka_position('{"logOffset":3}') == recovery.kafka_position("7") == recovery.kafka_position("x") == {}


def test_broken_checkpoints_are_refused(spark, tmp_path):
    at = f"file://{tmp_path}/none"
    assert recovery.last_committed(spark, at) is None and recovery.query_id(spark, at) is None
    (tmp_path / "empty" / "offsets").mkdir(parents=True)
    for where in (at, f"file://{tmp_path}/empty"):
        with pytest.raises(recovery.BrokenCheckpoint):
            recovery.checkpoint_state(spark, where)
        with pytest.raises(recovery.BrokenCheckpoint):
            recovery.source_offsets(spark, where)
    cut = _checkpoint(spark, f"file://{tmp_path}/cut", [0], [], "not json at all")
    with pytest.raises(recovery.BrokenCheckpoint):
        recovery.source_offsets(spark, cut)
    with pytest.raises(recovery.BrokenCheckpoint):
        recovery.source_offsets(spark, _checkpoint(spark, f"file://{tmp_path}/one", [0], []), 9)


def test_sweep_resumes(spark, tmp_path, monkeypatch):
    rows, at = clicks(spark, [("1", "a", 0, "/", "v", "x"), ("2", "a", 3000, "/", "v", "y")]), f"file://{tmp_path}/s"
    assert sweeps.sweep_results(spark, at).count() == 0
    assert sweeps.resumable_gap_sweep(rows, ["30 minutes"], at).first().recovered == 2
    ran, sweep = [], sweeps.gap_sweep
    monkeypatch.setattr(sweeps, "gap_sweep", lambda e, gaps, *how: ran.extend(gaps) or sweep(e, gaps, *how))
    assert {r.gap: r.recovered for r in sweeps.resumable_gap_sweep(rows, ["30 minutes", "1 hour"], at).collect()} == {"30 minutes": 2, "1 hour": 1}
    assert ran == ["1 hour"]
    with pytest.raises(ValueError):
        sweeps.resumable_gap_sweep(rows, [], at)


def test_dedupe_alternatives_on_a_copy_stamped_anew(spark):
    rows = clicks(spark, [("1", "a", 0, "/", "v"), ("1", "a", 30, "/", "v", "h", 9)])
    assert (sessions.dedupe(rows).count(), sessions.dedupe_by(rows, "event_id").count(), sessions.dedupe_by(rows, "event_id", "event_ts").count()) == (1, 1, 2)


def test_refused_rows_are_counted(spark, tmp_path):
    good = '{"event_id":"%d","user_id":"u","event_ts":"2024-01-01T00:00:0%d.000Z","ingest_ts":"2024-01-01T00:00:09.000Z"}'
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join([good % (i, i) for i in range(3)] + ["not json", "{}"]) + "\n")
    (tmp_path / "in" / "b.json").write_text(good % (7, 7) + "\n")
    sessions_of = job.pipeline(read_file_stream(spark, f"file://{tmp_path}/in", 1))
    query, batches = progress.watched(spark, lambda: job.start(sessions_of, f"file://{tmp_path}/cp", out=f"file://{tmp_path}/out"))
    seen = progress.frame(spark, batches)
    r = progress.refused_rows(seen).first()
    assert (r.parsed_rows, r.refused_rows) == (6, 2)
    assert [x.batchId for x in seen.where("numInputRows > 0").select("batchId").collect()] == [0, 1]
    assert sorted(map(json.loads, batches), key=str) == sorted((json.loads(x.json) for x in query.recentProgress), key=str)  # fewer than a hundred


def _wire(i, user="u", minute=0):
    return json.dumps({"event_id": str(i), "user_id": user, "event_ts": f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00.000Z", "ingest_ts": f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:01.000Z"})


@pytest.mark.parametrize("point", ["before-merge", "after-merge", "between", "after-both"])
def test_two_sinks_hold_each_row_once_after_a_stop(spark, tmp_path, point):
    (tmp_path / "in").mkdir()
    for n in range(3):
        (tmp_path / "in" / f"{n}.json").write_text("\n".join([_wire(10 * n + i, f"u{i}", 60 * n) for i in range(3)] + ["not json", _wire(n, None), '{"event_id":"x"}']) + "\n")
    (tmp_path / "in" / "9.json").write_text(_wire(99, "u_flush0", 1200) + "\n")
    for n in (0, 1, 2, 9):  # files are read in the order of their times
        os.utime(tmp_path / "in" / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    at = f"file://{tmp_path}"
    known = lambda: recovery.query_id(spark, f"{at}/cp")
    rows = lambda: job.pipeline_with_refused(read_file_stream(spark, f"{at}/in", 1))
    table = upsert.SessionTable(spark, f"{at}/table", rows().select("session.*").schema)
    first, second = job.upsert_sink(table, query_id=known), job.refused_sink(spark, f"{at}/refused", known)
    stopping = {
        "before-merge": job.both_sinks(job.Stopping(first, 1, "before-merge"), second), "after-merge": job.both_sinks(job.Stopping(first, 1, "after-merge"), second),
        "between": job.both_sinks(first, job.Stopping(second, 1, "before-merge")), "after-both": job.both_sinks(first, job.Stopping(second, 1, "after-merge")),
    }[point]
    with pytest.raises(Exception, match="batch 1"):
        job.start(rows(), f"{at}/cp", sink=stopping).awaitTermination()
    job.start(rows(), f"{at}/cp", sink=job.both_sinks(first, second)).awaitTermination()
    told = job.read_refused(spark, f"{at}/refused")
    assert sorted((r.value, r.reason) for r in told.collect()) == sorted([("not json", "document"), ('{"event_id":"x"}', "user_id")] * 3 + [(_wire(n, None), "user_id") for n in range(3)])
    assert told.select("batch").distinct().count() == 3
    assert sorted((r.user_id, r.session_start.hour) for r in table.read().collect()) == sorted((f"u{i}", n) for i in range(3) for n in range(3))


def test_progress_log_keeps_one_history_of_two_runs(spark, tmp_path):
    (tmp_path / "in").mkdir()
    at, runs = f"file://{tmp_path}", []
    for n in range(2):
        (tmp_path / "in" / f"{n}.json").write_text(_wire(n, "u", n) + "\nnot json\n")
        summary = job.main(["--path", f"{at}/in", "--checkpoint", f"{at}/cp", "--sink", "table", "--table", f"{at}/table", "--quarantine", f"{at}/refused", "--available-now", "--files-per-trigger", "1", "--summary-json", str(tmp_path / "summary"), "--progress-json", str(tmp_path / "progress")])
        assert summary["refused_rows"] == 1 and summary["rows"] >= 1 and json.loads((tmp_path / "summary").read_text())["batches"] == summary["batches"]
        runs.append(len(json.loads((tmp_path / "progress").read_text())))
    seen = progress.history(spark, f"{at}/cp-progress")
    assert seen.count() == sum(runs) and seen.select("runId").distinct().count() == 2 and seen.select("query").distinct().count() == 1
    assert [r.batchId for r in seen.orderBy("batchId").collect()] == list(range(sum(runs))) and progress.history(spark, f"{at}/cp-progress", 1).count() == sum(runs) - 2
    assert job.read_refused(spark, f"{at}/refused").count() == 2
    assert progress.history(spark, f"{at}/nothing").count() == 0


def test_main_writes_parquet_and_stops_where_told(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(_wire(1) + "\n" + _wire(2, "u_flush0", 600) + "\n")
    at = f"file://{tmp_path}"
    job.main(["--path", f"{at}/in", "--checkpoint", f"{at}/cp", "--out", f"{at}/out", "--seconds", "8"])
    assert spark.read.parquet(f"{at}/out").count() == 1
    with pytest.raises(Exception, match="batch 0"):
        job.main(["--path", f"{at}/in", "--checkpoint", f"{at}/cp2", "--sink", "table", "--table", f"{at}/t", "--available-now", "--crash-batch", "0"])
    for wrong in (["--quarantine", "q", "--out", "o"], ["--crash-batch", "1", "--out", "o"], ["--sink", "table"], []):
        with pytest.raises(SystemExit):
            job.main(["--path", "p", "--checkpoint", "c", *wrong])


def test_progress_log_stays_small_over_many_batches(spark, tmp_path):
    class Event:
        def __init__(self, n):
            self.progress = type("P", (), {"runId": "r", "batchId": n, "json": json.dumps({"id": "q", "runId": "r", "batchId": n, "numInputRows": 1})})

    log = progress.ProgressLog(spark, f"file://{tmp_path}/log", many=50)
    for n in range(1000):
        log.onQueryProgress(Event(n))
    log.onQueryProgress(Event(999))
    assert not log._batches and log._loose == {"r": 0} and len(log._files.names("r")) == 20
    assert progress.history(spark, log.folder).agg(F.count("*"), F.sum("numInputRows"), F.max("batchId")).first() == (1000, 1000, 999)


def test_progress_of_a_run_that_does_not_end():
    class Open:
        runId = "r"

    with pytest.raises(TimeoutError):
        progress.Progress().of(Open(), 0.01)


def test_one_session_join_in_emission_lag(spark, sf):
    built = catalog._built(spark, sf)
    lag = latency.emission_lag(catalog.clicks(spark, sf), built)
    lag.collect()
    assert "MergingSessions" not in lag._jdf.queryExecution().executedPlan().toString()  # the histogram is kept as a table


def test_progress(spark):
    docs = [json.dumps({"batchId": i, "numInputRows": 10, "durationMs": {"addBatch": 5 + i, "triggerExecution": 10}, "stateOperators": [{"operatorName": "sessionWindowStateStoreSaveExec", "numRowsTotal": i, "memoryUsedBytes": 1, "numRowsDroppedByWatermark": 2}]}) for i in range(3)]
    p = progress.frame(spark, docs)
    r = progress.session_operator(p).first()
    assert (r.dropped, r.state_rows) == (6, 2)
    assert progress.batch_latency(p).first().rows_a_second == 1000
    with pytest.raises(ValueError):
        progress.session_operator(p.withColumn("stateOperators", F.slice("stateOperators", 1, 0)))


def test_generator(spark):
    how = dict(rate=50, seconds=600, users=1500, pool=100, seed=3)
    made = generator.all_events(spark, **how).persist()
    e = generator.events(spark, **how)
    assert e.exceptAll(made.where("not pending").drop("copy", "pending")).count() == 0
    n = {r.event_type: r["count"] for r in made.where("not copy").groupBy("event_type").count().collect()}
    assert n["checkout"] <= n["add_to_cart"] <= n["click"] and n["page_view"] == max(n.values())
    assert e.where("ingest_ts < event_ts").count() == 0 and made.where("copy").count() > 0
    visits = made.where("not copy").groupBy("user_id", "session_hint").agg(F.min("event_ts").alias("a"), F.max("event_ts").alias("b"), F.min_by("event_type", "event_ts").alias("first"))
    x, y = visits.alias("x"), visits.alias("y")
    assert visits.where("first = 'scroll'").count() == 0
    r = generator.statistics(made).first()
    assert r.originals + r.duplicates == r.emitted and r.distinct_users <= 1500 and r.visits == visits.count() and 4 < r.lateness_p50_s < 30 and 0 < r.top_share < 1
    assert abs(r.originals - 30_000) < 9000 and 20 < r.mean_occupancy <= 130
    for wrong in (dict(pool=0), dict(visit_events=0.5), dict(users=100, pool=51)):
        with pytest.raises(ValueError):
            generator.events(spark, **wrong)
    assert generator.events(spark, users=100, pool=50, seconds=20).count() > 0


@pytest.mark.parametrize("users", [1, 63, 64, 65, 100_000, 100_001])
@pytest.mark.parametrize("alpha", [0.0, 1.0, 1.4, 2.0])
def test_generator_weights_sum_alike_at_every_size(users, alpha):
    assert generator.total_weight(users, alpha) == pytest.approx(sum(i**-alpha for i in range(1, users + 1)), rel=1e-9)


def test_generator_deflects_arrivals_of_users_on_the_site(spark):
    how = dict(rate=50, seconds=600, pool=100, visit_events=6, visit_sigma=0.9, seed=1, population_seed=1)
    steep, flat = (generator.visits(spark, users=u, alpha=a, **how) for u, a in ((400, 2.5), (50_000, 0.0)))
    assert steep.agg(F.sum("deflected")).first()[0] > 10 * max(flat.agg(F.sum("deflected")).first()[0], 1)
    order = "lag(end) over (partition by id order by begin)"
    assert steep.selectExpr("begin", f"{order} as last").where("begin <= last").count() == 0


def test_repro(spark):
    kind = "name string, published double, measured double, kind string"
    assert repro.report(spark.createDataFrame([("a", 10.0, 11.0, "counted"), ("b", 0.0, 1.0, "timing")], kind)).first().asDict() == {"reproduced": 0, "differs": 1, "moved": 1}
    with pytest.raises(ValueError):
        repro.report(spark.createDataFrame([], kind))
    with pytest.raises(ValueError):
        repro.report(spark.createDataFrame([("a", 1.0, 1.0, "odd")], kind))


def test_shuffles_and_operator_order(spark, sf):
    plan = catalog.queries()["sessions_6h"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "MergingSessions" in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def _norm(rows):
    return sorted(repr(tuple(float(v) if isinstance(v, int | float) and not isinstance(v, bool) or v.__class__.__name__ == "Decimal" else v for v in r)) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_against_sql(spark, sf, name):
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{sf}/events.parquet'")
    got = catalog.queries()[name](spark, sf)
    cols = sorted(got.columns)
    ran = con.execute(catalog.oracle_sql()[name])
    names = [x[0] for x in ran.description]
    assert sorted(names) == cols
    assert _norm(got.select(*cols).collect()) == _norm([[r[names.index(c)] for c in cols] for r in ran.fetchall()])


def test_entry(spark):
    assert entry.entry(spark).count() == 585


def test_stands_without_the_training_data_operators(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "sessionforge", tmp_path / "sessionforge", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (root / name).exists():
            shutil.copy(root / name, tmp_path)
    says = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, any(n.startswith('op') and n[2].isdigit() for n in q), set(e.oracle_sql()) <= set(q))"
    ran = subprocess.run([sys.executable, "-c", says], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert ran.stdout.split()[1:] == ["False", "False", "True"] and int(ran.stdout.split()[0]) == len(catalog.queries()), ran.stderr
