"""The registered queries of the engine itself and the DuckDB SQL each is held against."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionforge.fixtures import CLICKS_SQL, clicks
from sessionforge.functions import sql
from sessionforge.functions.partitioners import crc32_partition, murmur2_partition
from sessionforge.operators import digests, latency, partitions, scoring, upsert
from sessionforge.operators import sessions as S
from sessionforge.plans import repro, sweeps
from sessionforge.schema import parse, parse_failures, seconds_between
from sessionforge.sources.files import read_file_stream, shared_folder, staged, to_json_lines, write_flush
from sessionforge.streaming import job, progress, recovery

GAP, WIN = "6 hours", "purchase"


def _built(spark, d, gap=GAP) -> DataFrame:
    return S.build_batch(clicks(spark, d), gap, WIN)


def _out(sessions: DataFrame) -> DataFrame:
    us = lambda c: F.unix_micros(c)
    return sessions.select("user_id", us("session_start").alias("session_start_us"), us("session_end").alias("session_end_us"), F.col("event_count").cast("long").alias("event_count"), F.col("page_depth").cast("long").alias("page_depth"), F.round(F.col("duration_s") * 1e6).cast("long").alias("duration_us"), F.col("converted").cast("int").alias("converted"), F.col("bounce").cast("int").alias("bounce"), F.round(F.col("window_span_s") * 1e6).cast("long").alias("window_span_us"))


def _dedupe(d: str = "clicks") -> str:
    return f"d as (select * from {d} qualify row_number() over (partition by event_id order by ingest_ts) = 1)"


def _sessions_sql(gap: str) -> str:
    return f"""{_dedupe()},
nb as (select *, case when event_ts - lag(event_ts) over w <= interval '{gap}' then 0 else 1 end as nb from d window w as (partition by user_id order by event_ts, event_id)),
si as (select *, sum(nb) over (partition by user_id order by event_ts, event_id rows unbounded preceding) as sid from nb),
s as (select user_id, min(event_ts) as session_start, max(event_ts) + interval '{gap}' as session_end, count(*) as event_count, count(distinct page) as page_depth,
  epoch_us(max(event_ts)) - epoch_us(min(event_ts)) as duration_us, max(case when event_type = 'purchase' then 1 else 0 end)::int as converted from si group by user_id, sid)"""


_W = f"with {CLICKS_SQL},\n"
_SESSION_ROWS = """select user_id, epoch_us(session_start) as session_start_us, epoch_us(session_end) as session_end_us, event_count, page_depth, duration_us, converted,
  case when page_depth = 1 and event_count = 1 then 1 else 0 end::int as bounce, epoch_us(session_end) - epoch_us(session_start) as window_span_us from s"""
_ATTACH = "a as (select c.*, s.session_start, s.session_end from clicks c left join s on c.user_id = s.user_id and c.event_ts >= s.session_start and c.event_ts < s.session_end)"
_Q: dict[str, tuple] = {}


def _query(name: str, sql: str | None = None):
    def add(f):
        _Q[name] = (f, sql)
        return f

    return add


def _sessions(name: str, gap: str) -> None:
    _Q[name] = (lambda spark, d: _out(_built(spark, d, gap)), f"{_W}{_sessions_sql(gap)} {_SESSION_ROWS}")


for _name, _gap in (("sessions_30m", "30 minutes"), ("sessions_2h", "2 hours"), ("sessions_6h", "6 hours"), ("sessions_1d", "1 day"), ("session_features", "6 hours")):
    _sessions(_name, _gap)


@_query("dedupe_events", f"{_W}{_dedupe()} select event_id, user_id, session_hint, event_type, page, epoch_us(event_ts) as event_us, epoch_us(ingest_ts) as ingest_us from d")
def _(spark, d):
    return S.dedupe(clicks(spark, d)).select("event_id", "user_id", "session_hint", "event_type", "page", F.unix_micros("event_ts").alias("event_us"), F.unix_micros("ingest_ts").alias("ingest_us"))


def _lines(spark, d) -> DataFrame:
    """The clicks as wire documents, some with times that can't be read."""
    c = clicks(spark, d)
    good = to_json_lines(c)
    bad = c.where("cast(event_id as long) % 50 = 7").select(F.to_json(F.struct("event_id", "user_id", F.lit("15/08/2026 12:00:00").alias("event_ts"), F.lit("2024-01-01T00:00:00Z").alias("ingest_ts"))).alias("value"))
    return good.unionByName(bad)


#: The wire has milliseconds.
_CLICKS_MS = f"{CLICKS_SQL.replace('clicks as (', 'exact as (', 1)}, clicks as (select * replace (date_trunc('milliseconds', event_ts) as event_ts, date_trunc('milliseconds', ingest_ts) as ingest_ts) from exact)"
_PARSED = "select event_id, user_id, event_type, page, epoch_us(event_ts) as event_us, epoch_us(ingest_ts) as ingest_us, epoch_us(ingest_ts) - epoch_us(event_ts) as late_us from clicks"
_BAD = "select event_id, user_id, cast(null as varchar), cast(null as varchar), cast(null as bigint), cast(null as bigint), cast(null as bigint) from clicks where cast(event_id as bigint) % 50 = 7"


@_query("parse_events", f"with {_CLICKS_MS} {_PARSED} union all {_BAD}")
def _(spark, d):
    return parse(_lines(spark, d)).select("event_id", "user_id", "event_type", "page", F.unix_micros("event_ts").alias("event_us"), F.unix_micros("ingest_ts").alias("ingest_us"), F.round(F.col("lateness_s") * 1e6).cast("long").alias("late_us"))


@_query("parse_failures", f"with {CLICKS_SQL} select event_id, user_id from clicks where cast(event_id as bigint) % 50 = 7")
def _(spark, d):
    return parse_failures(parse(_lines(spark, d))).select("event_id", "user_id")


@_query("window_span", f"{_W}{_sessions_sql(GAP)} select count(*) as sessions, sum(duration_us)::bigint as duration_us, sum(epoch_us(session_end) - epoch_us(session_start))::bigint as span_us from s")
def _(spark, d):
    return _out(_built(spark, d)).agg(F.count(F.lit(1)).alias("sessions"), F.sum("duration_us").alias("duration_us"), F.sum("window_span_us").alias("span_us"))


@_query("attach_sessions", f"{_W}{_sessions_sql(GAP)}, {_ATTACH} select event_id, user_id, epoch_us(ingest_ts) as ingest_us, epoch_us(session_start) as session_start_us from a")
def _(spark, d):
    return scoring.attach(clicks(spark, d), _built(spark, d)).select("event_id", "user_id", F.unix_micros("ingest_ts").alias("ingest_us"), F.unix_micros("session_start").alias("session_start_us"))


_CARD = f"""{_W}{_sessions_sql(GAP)}, {_ATTACH},
h as (select user_id, session_start, count(distinct session_hint) as hints from a where session_start is not null group by all),
p as (select session_hint, count(distinct (user_id, session_start)) as parts from a where session_start is not null and session_hint is not null group by all),
t as (select count(*) as events_joined, count(*) filter (session_start is null) as unmatched, count(distinct session_hint) as true_sessions, count(distinct session_hint) filter (session_start is not null) as true_scored from a),
l as (select count(*) as recovered, count(*) filter (hints > 1) as merged, coalesce(sum(hints - 1), 0)::bigint as boundaries_lost from h), x as (select count(*) filter (parts > 1) as split from p)
"""
_RATES = "round(coalesce(boundaries_lost / nullif(true_scored, 0), 0.0), 4) as boundary_miss_rate, round(coalesce(split / nullif(true_scored, 0), 0.0), 4) as split_rate"


@_query("scorecard", f"{_CARD} select *, {_RATES} from t, l, x")
def _(spark, d):
    return scoring.scorecard(clicks(spark, d), _built(spark, d))


@_query("boundaries_lost", f"{_CARD} select recovered, merged, boundaries_lost from l")
def _(spark, d):
    return scoring.scorecard(clicks(spark, d), _built(spark, d)).select("recovered", "merged", "boundaries_lost")


@_query("splits", f"{_CARD} select split, true_scored from t, x")
def _(spark, d):
    return scoring.scorecard(clicks(spark, d), _built(spark, d)).select("split", "true_scored")


@_query("overlapping_sessions", f"{_W}{_sessions_sql(GAP)}, o as (select user_id, session_start, lag(session_end) over (partition by user_id order by session_start) as e from s) select user_id from o where session_start < e")
def _(spark, d):
    return scoring.overlaps(_built(spark, d)).select("user_id")


_TRUTH = f"""{_dedupe()}, th as (select session_hint, count(*) as event_count, count(distinct page) as page_depth, epoch_us(max(event_ts)) - epoch_us(min(event_ts)) as duration_us,
  max(case when event_type = 'purchase' then 1 else 0 end)::int as converted from d group by session_hint)"""


@_query("truth_features", f"{_W}{_TRUTH} select *, case when page_depth = 1 and event_count = 1 then 1 else 0 end::int as bounce from th")
def _(spark, d):
    return scoring.truth_features(clicks(spark, d), WIN).select("session_hint", "event_count", "page_depth", F.round(F.col("duration_s") * 1e6).cast("long").alias("duration_us"), "converted", "bounce")


def _means(table: str) -> str:
    return " union all ".join(f"select '{f}' as feature, {e} as m from {table}" for f, e in (("event_count", "sum(event_count) / count(*)"), ("page_depth", "sum(page_depth) / count(*)"), ("duration_s", "sum(duration_us) / 1e6 / count(*)"), ("converted", "sum(converted) / count(*)"), ("bounce", "sum(case when page_depth = 1 and event_count = 1 then 1 else 0 end) / count(*)")))


@_query("feature_bias", f"{_W}{_sessions_sql(GAP)}, {_TRUTH.split(', th as', 1)[1].join(['th as', ''])}, mt as ({_means('th')}), ms as ({_means('s')}) select feature, round(mt.m, 4) as truth, round(ms.m, 4) as recovered, round(ms.m / nullif(mt.m, 0), 4) as ratio from mt join ms using (feature)")
def _(spark, d):
    once = staged(S.dedupe(clicks(spark, d)), "once")
    return scoring.feature_bias(once, S.split_sessions(once, GAP, WIN), WIN, deduped=True)


def _qc(expr: str, source: str, more: str = "") -> str:
    return f"select count({expr}) as rows, " + ", ".join(f"round(quantile_cont(({expr})::double, {q}) / 1e6, 4) as p{p}_s" for q, p in ((0.5, 50), (0.95, 95), (0.99, 99))) + more + f" from {source}"


_LAG = "epoch_us(ingest_ts) - epoch_us(event_ts)"


@_query("ingest_lag", f"with {CLICKS_SQL} {_qc(_LAG, 'clicks', f', round(max({_LAG}) / 1e6, 4) as max_s, count(*) filter ({_LAG} > 0) as late, round(count(*) filter ({_LAG} > 0) / count(*), 4) as late_share')}")
def _(spark, d):
    return latency.ingest_lag(clicks(spark, d))


@_query("emission_lag", f"{_W}{_sessions_sql(GAP)}, {_ATTACH} {_qc('epoch_us(session_end) + 120000000 - epoch_us(event_ts)', 'a', ', count(*) filter (session_end is null) as unmatched')}")
def _(spark, d):
    return latency.emission_lag(clicks(spark, d), _built(spark, d))


@_query("end_to_end_lag", f"{_W}{_sessions_sql(GAP)}, {_ATTACH} {_qc('epoch_us(session_end) + 120000000 - 2 * epoch_us(event_ts) + epoch_us(ingest_ts)', 'a where session_end is not null')}")
def _(spark, d):
    return latency.end_to_end(clicks(spark, d), _built(spark, d))


@_query("session_span", f"{_W}{_sessions_sql(GAP)} {_qc('duration_us', 's')}")
def _(spark, d):
    return latency.session_span(_built(spark, d))


@_query("floor_check", f"{_W}{_sessions_sql(GAP)}, {_ATTACH}, g as (select max(epoch_us(session_end)) - max(epoch_us(event_ts)) as t from a where session_end is not null group by user_id, session_start) select round(min(t) / 1e6, 4) as least_s, round(max(t) / 1e6, 4) as largest_s from g")
def _(spark, d):
    return latency.floor_check(clicks(spark, d), _built(spark, d))


@_query("lag_budget", f"with {CLICKS_SQL}, q as (select round(quantile_cont(({_LAG})::double, 0.5) / 1e6, 4) as i from clicks), t as (select i, 21720.0::double as w, i + 21720.0::double as total from q) select i as ingest_s, w as wait_s, 0.0::double as batch_s, total as total_s, round(i / total, 4) as ingest_share, round(w / total, 4) as wait_share, 0.0::double as batch_share, 60.0::double as goal_s, round(total / 60, 4) as over_by from t")
def _(spark, d):
    return latency.lag_budget(clicks(spark, d), GAP)


@_query("lateness_profile", f"with {CLICKS_SQL}, l as (select {_LAG} as lag from clicks where {_LAG} > 0) {_qc('lag', 'l', ', round(max(lag) / 1e6, 4) as max_s, round(count(*) filter (lag > 60000000) / count(*), 4) as over_60_s, round(count(*) filter (lag > 300000000) / count(*), 4) as over_300_s')}")
def _(spark, d):
    return latency.lateness_profile(clicks(spark, d))


@_query("gap_rule_misses", f"""with {CLICKS_SQL}, r as (select *, max(event_ts) over (partition by user_id order by ingest_ts, event_id rows between unbounded preceding and 1 preceding) as newest,
  row_number() over (partition by user_id, session_hint order by ingest_ts, event_id) as n from clicks),
v as (select not (newest is null or event_ts - newest > interval '30 minutes') as missed from r where n = 1) select count(*) as visits, count(*) filter (missed) as missed, round(count(*) filter (missed) / count(*), 4) as miss_rate from v""")
def _(spark, d):
    return partitions.gap_misses(clicks(spark, d))


def _sweep_sql(gap: str, floor: float) -> str:
    # One SELECT for each gap, each with its own WITH list.
    return f"select * from ({_CARD.replace(_sessions_sql(GAP), _sessions_sql(gap))} select '{gap}' as gap, {floor}::double as floor_s, recovered, merged, boundaries_lost, split, {_RATES} from t, l, x)"


@_query("gap_sweep", " union all ".join(_sweep_sql(g, f) for g, f in (("30 minutes", 1920.0), ("2 hours", 7320.0), ("1 day", 86520.0))))
def _(spark, d):
    return sweeps.gap_sweep(clicks(spark, d), ("30 minutes", "2 hours", "1 day"), conversion=WIN)


@_query("gap_sweep_resumed", " union all ".join(_sweep_sql(g, f) for g, f in (("30 minutes", 1920.0), ("1 day", 86520.0))))
def _(spark, d):
    """Stopped after the first gap and taken up again."""
    c, results = clicks(spark, d), shared_folder(spark, "sweep")
    sweeps.resumable_gap_sweep(c, ("30 minutes",), results, conversion=WIN)
    return sweeps.resumable_gap_sweep(c, ("30 minutes", "1 day"), results, conversion=WIN)


@_query("late_admission", f"""with {CLICKS_SQL}, r as (select event_id, epoch_us(event_ts) as e, epoch_us(ingest_ts) as i, max(epoch_us(event_ts)) over (order by epoch_us(ingest_ts), event_id, epoch_us(event_ts) rows between unbounded preceding and 1 preceding) as top from clicks)
select event_id from r where e + 1000000 < top - 2000000""")
def _(spark, d):
    return S.late_admission(clicks(spark, d), 1, 2)


@_query("user_skew", f"with {CLICKS_SQL} select user_id, count(*) as events from clicks group by user_id")
def _(spark, d):
    return partitions.user_counts(clicks(spark, d))


@_query("top_k_share", f"with {CLICKS_SQL}, c as (select user_id, count(*) as n from clicks group by user_id), t as (select n from c order by n desc limit 50) select (select count(*) from t) as k, round((select sum(n) from t) / (select sum(n) from c), 4) as share")
def _(spark, d):
    return partitions.top_k_share(clicks(spark, d), 50)


#: The six-way partition of each user by CRC-32 (``cp``) and by murmur2 (``mp``), from the bytes of the key.
_PLACED = f"""with {CLICKS_SQL}, counts as (select user_id, count(*) as events from clicks group by user_id),
keyed as (select user_id, events, octet_length(encode(user_id)) as n, list_transform(range(octet_length(encode(user_id))), lambda i: ('0x' || substr(hex(user_id), 2 * i + 1, 2))::bigint) as b from counts),
worded as (select *, list_transform(range((n + 3) // 4), lambda i: list_sum(list_transform(range(4), lambda j: coalesce(b[4 * i + j + 1], 0) * (1 << (8 * j))))::bigint) as w,
  xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(b, lambda x: [x, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: case when x >= 0 then xor(c, x) else xor(c >> 1, 3988292384 * (c & 1)) end), 4294967295) as crc from keyed),
body as (select *, list_reduce(list_concat([xor(2538058380::bigint, n)], w[1 : n // 4]),
  lambda h, k: xor((h * 1540483477) & 4294967295, (xor((k * 1540483477) & 4294967295, ((k * 1540483477) & 4294967295) >> 24) * 1540483477) & 4294967295)) as h from worded),
tail as (select *, case when n % 4 = 0 then h else (xor(h, w[n // 4 + 1]) * 1540483477) & 4294967295 end as t from body),
mixed as (select *, (xor(t, t >> 13) * 1540483477) & 4294967295 as z from tail),
placed as (select user_id, events, (crc % 6)::int as cp, ((xor(z, z >> 15) & 2147483647) % 6)::int as mp from mixed)"""


def _loads_sql(by: str) -> str:
    return f"select p::int as partition, coalesce(sum(events), 0)::bigint as events, count(user_id) as users from range(6) r(p) left join placed on placed.{by} = p group by p"


@_query("partition_crc32", f"{_PLACED} {_loads_sql('cp')}")
def _(spark, d):
    return partitions.partition_loads(clicks(spark, d), 6, crc32_partition)


@_query("partition_murmur2", f"{_PLACED} {_loads_sql('mp')}")
def _(spark, d):
    return partitions.partition_loads(clicks(spark, d), 6, murmur2_partition)


@_query("partition_skew", f"{_PLACED}, loads as ({_loads_sql('cp')}) select round(max(events) / (sum(events) / 6), 4) as busiest, round(min(events) / (sum(events) / 6), 4) as quietest from loads")
def _(spark, d):
    return partitions.partition_skew(clicks(spark, d))


@_query("partition_divergence", f"{_PLACED} select count(*) as keys, count(*) filter (cp != mp) as differ, round(count(*) filter (cp != mp) / count(*), 4) as rate, 0.8333::double as expected from placed")
def _(spark, d):
    return partitions.divergence(clicks(spark, d))


@_query("partition_disagreements", f"""{_PLACED}, off as (select * from placed where cp != mp order by user_id limit 5)
select count(*) as keys, count(*) filter (cp != mp) as disagree, count(distinct mp) as partitions_seen, count(distinct cp) as partitions_modelled, count(*) filter (cp != mp) = 0 as agrees,
  coalesce((select string_agg(concat_ws(':', user_id, mp, cp), ' ' order by user_id) from off), '') as examples from placed""")
def _(spark, d):
    seen = clicks(spark, d).select("user_id", murmur2_partition(F.col("user_id"), 6).alias("partition")).distinct()
    named = F.transform("examples", lambda x: F.concat_ws(":", x["user_id"], x["seen"].cast("string"), x["model"].cast("string")))
    return partitions.disagreements(seen).withColumn("examples", F.array_join(named, " "))


@_query("session_shape", f"""with {CLICKS_SQL}, e as (select session_hint, count(*) as n, max(case when event_type = 'purchase' then 1 else 0 end) as won from clicks group by 1),
r as (select n, row_number() over (order by n) - 1 as i, count(*) over () as c from e)
select (select min(n) from r where i >= floor(c * 0.5)) as p50, (select min(n) from r where i >= floor(c * 0.95)) as p95, count(*) as sessions, round(avg((n = 1)::int), 4) as single, round(avg(won), 4) as converting from e""")
def _(spark, d):
    return partitions.session_shape(clicks(spark, d), WIN)


@_query("event_mix", f"with {CLICKS_SQL} select event_type, count(*) as events, round(count(*) / (select count(*) from clicks), 4) as share from clicks group by event_type")
def _(spark, d):
    return partitions.event_mix(clicks(spark, d))


@_query("upsert_sessions", f"{_W}{_sessions_sql(GAP)} {_SESSION_ROWS}")
def _(spark, d):
    """Half the sessions, then all of them with the first half changed, into one table."""
    rows = _built(spark, d)
    table = upsert.SessionTable(spark, shared_folder(spark, "upsert"), rows.schema)
    table.apply(rows.where("crc32(user_id) % 2 = 0").withColumn("event_count", F.lit(0).cast("long")), "q", 0)
    table.apply(rows, "q", 1)
    return _out(table.read())


@_query("upsert_replay", f"{_W}{_sessions_sql(GAP)} select 0::bigint as inserted, count(*) as updated from s")
def _(spark, d):
    rows = _built(spark, d)
    table = upsert.SessionTable(spark, shared_folder(spark, "replay"), rows.schema)
    table.apply(rows, "q", 0)
    return upsert.accounting(table.read(), rows)


@_query("duplicate_keys", f"{_W}{_sessions_sql(GAP)} select user_id, epoch_us(session_start) as session_start_us, count(*) as n from s group by 1, 2 having count(*) > 1")
def _(spark, d):
    return upsert.duplicate_keys(_built(spark, d)).select("user_id", F.unix_micros("session_start").alias("session_start_us"), F.col("count").alias("n"))


def _tree_sql(rows: str) -> str:
    """``root``: rows and digest over ``rows`` with the columns of the sessions."""
    up = "".join(f", d{n} as (select substr(path, 1, {n}) as path, sum(n) as n, md5(string_agg(path || '=' || d, ',' order by path)) as d from d{n + 1} group by 1)" for n in (2, 1, 0))
    return f"""l as (select substr(md5(concat_ws('|', user_id, session_start_us)), 1, 3) as path, md5(concat_ws('|', user_id, session_start_us, session_end_us, event_count, page_depth, duration_us, converted, bounce, window_span_us)) as line from {rows}),
d3 as (select path, count(*) as n, md5(concat_ws(':', count(*), sum(('0x' || substr(line, 1, 15))::bigint::hugeint), sum(('0x' || substr(line, 16, 15))::bigint::hugeint))) as d from l group by path){up}, root as (select n::bigint as rows, d as digest from d0)"""


@_query("session_fingerprint", f"{_W}{_sessions_sql(GAP)}, r as ({_SESSION_ROWS}), {_tree_sql('r')} select * from root")
def _(spark, d):
    return digests.root(digests.leaves(_out(_built(spark, d)), ("user_id", "session_start_us")))


@_query("differing_keys", f"""{_W}{_sessions_sql(GAP)}, r as ({_SESSION_ROWS}), n as (select *, ('0x' || substr(md5(concat_ws('|', user_id, session_start_us)), 1, 8))::bigint as i from r)
select user_id, session_start_us, case when i % 97 = 0 then 'both' when i % 101 = 0 then 'left' else 'right' end as side from n where i % 97 = 0 or i % 101 = 0 or i % 103 = 0""")
def _(spark, d):
    """By a hash of the key one session in 97 has another value on the right, one in 101 is only left, one in 103 only right."""
    i = F.conv(F.substring(F.md5(F.concat_ws("|", "user_id", F.col("session_start_us").cast("string"))), 1, 8), 16, 10).cast("long")
    rows = staged(_out(_built(spark, d)).withColumn("i", i), "numbered")
    left = rows.where("i % 97 = 0 or i % 101 = 0 or i % 103 != 0").drop("i")
    right = rows.where("i % 97 = 0 or i % 101 != 0").withColumn("event_count", F.when(F.col("i") % 97 == 0, -1).otherwise(F.col("event_count"))).drop("i")
    return digests.differing_keys(left, right, ("user_id", "session_start_us"))


def _shards(spark, d) -> str:
    """The clicks as a folder of JSON lines with the flush row in a file that sorts last."""
    folder = shared_folder(spark, "shards")
    c = clicks(spark, d)
    to_json_lines(c).repartition(4, F.col("value")).write.text(folder)
    write_flush(spark, folder)
    return folder


def _streamed(spark, d):
    out, cp = shared_folder(spark, "sessions"), shared_folder(spark, "checkpoint")
    stream = job.pipeline(read_file_stream(spark, _shards(spark, d)), GAP, "2 minutes", WIN)
    _, batches = progress.watched(spark, lambda: job.start(stream, cp, out=out))
    return spark.read.schema(stream.schema).parquet(out), cp, progress.frame(spark, batches)


@_query("stream_sessions_6h", f"with {_CLICKS_MS}, {_sessions_sql(GAP)} {_SESSION_ROWS}")
def _(spark, d):
    return _out(scoring.without_sentinel(_streamed(spark, d)[0]))


_OWN = "case when cast(substr(user_id, 3) as bigint) % 7 = 0 then 6 else 2 + cast(substr(user_id, 3) as bigint) % 5 end"


@_query("stream_sessions_own_gap", f"""with {_CLICKS_MS}, {_dedupe()}, g as (select *, event_ts + to_hours({_OWN}) as until from d),
nb as (select *, case when event_ts <= max(until) over (partition by user_id order by event_ts, event_id rows between unbounded preceding and 1 preceding) then 0 else 1 end as nb from g),
si as (select *, sum(nb) over (partition by user_id order by event_ts, event_id rows unbounded preceding) as sid from nb),
s as (select user_id, min(event_ts) as session_start, max(until) as session_end, count(*) as event_count, count(distinct page) as page_depth, epoch_us(max(event_ts)) - epoch_us(min(event_ts)) as duration_us, max(case when event_type = 'purchase' then 1 else 0 end)::int as converted from si group by user_id, sid)
{_SESSION_ROWS}""")
def _(spark, d):
    """Six users in seven have a gap of their own, from two to six hours; the rest have the common one."""
    out = shared_folder(spark, "sessions")
    users = clicks(spark, d).select("user_id").distinct().where("cast(substr(user_id, 3) as long) % 7 != 0")
    gaps = users.withColumn("own_gap", F.concat(F.expr(_OWN).cast("string"), F.lit(" hours")))
    stream = job.pipeline(read_file_stream(spark, _shards(spark, d)), GAP, "2 minutes", WIN, gaps)
    job.start(stream, shared_folder(spark, "checkpoint"), out=out).awaitTermination()
    return _out(scoring.without_sentinel(spark.read.schema(stream.schema).parquet(out)))


@_query("sessions_sql", f"{_W}{_sessions_sql(GAP)} {_SESSION_ROWS}")
def _(spark, d):
    """The sessions as SQL text, by the table function."""
    S.dedupe(clicks(spark, d)).createOrReplaceTempView("clicks_once")
    sql.register_sessions(spark, "clicks_once")
    return _out(spark.sql(f"select * from sessions_of('{GAP}', '{WIN}')"))


@_query("partition_murmur2_sql", f"{_PLACED} select mp as partition, sum(events)::bigint as events, count(*) as users from placed group by mp")
def _(spark, d):
    sql.register(spark)
    clicks(spark, d).createOrReplaceTempView("clicks")
    return spark.sql("select partition, sum(events) as events, count(*) as users from (select murmur2_partition(user_id, 6) as partition, count(*) as events from clicks group by user_id) group by partition")


@_query("replay_matrix", f"with {_CLICKS_MS}, {_sessions_sql(GAP)}, n as (select count(*) as rows from s) select arm, verdict, case when verdict = 'identical' then rows end as rows from n, (values ('clean', 'identical'), ('crash-after', 'identical'), ('crash-before', 'identical'), ('fresh-checkpoint', 'identical'), ('wiped-table', 'REFUSED')) as arms(arm, verdict)")
def _(spark, d):
    """Runs that were stopped after and before a batch's merge, begun again from nothing, or robbed of their table, each against a clean one."""
    shards, where = _shards(spark, d), shared_folder(spark, "arms")
    return sweeps.replay_matrix(spark, lambda: read_file_stream(spark, shards, 2), where, GAP)


#: The clicks in ten files by three days of arrival; every 53rd event comes one file later, every 59th two.
_FILE = "least(9, (unix_micros(ingest_ts) - 1704067200000000) div 259200000000 + case when cast(event_id as bigint) % 59 = 0 then 2 when cast(event_id as bigint) % 53 = 0 then 1 else 0 end)"


def _late_shards(spark, d) -> str:
    """Files that are read in the order of their numbers, one a trigger, and the flush row after them."""
    folder = shared_folder(spark, "late")
    c = staged(clicks(spark, d).withColumn("file", F.expr(_FILE)), "arrivals")
    for n in range(10):
        to_json_lines(c.where(F.col("file") == n)).coalesce(1).write.mode("append").text(folder)
    write_flush(spark, folder)
    return folder


_RUNS: dict[tuple, tuple] = {}


def _late_run(spark, d, multiple: bool = True):
    """(checkpoint, progress documents) of a run over the late files; once for each application and table."""
    key = spark.sparkContext.applicationId, d, multiple
    if key not in _RUNS:
        out, cp, allow = shared_folder(spark, "sessions"), shared_folder(spark, "checkpoint"), "spark.sql.streaming.statefulOperator.allowMultiple"
        usual = spark.conf.get(allow)
        spark.conf.set(allow, str(multiple).lower())
        try:
            stream = job.pipeline(read_file_stream(spark, _late_shards(spark, d), 1), GAP, "2 minutes", WIN)
            _, batches = progress.watched(spark, lambda: job.start(stream, cp, out=out))
        finally:
            spark.conf.set(allow, usual)
        _RUNS[key] = cp, batches
    return _RUNS[key]


def _late_sql(delay_s: int, back: int = 2, clicks_ms: str = "") -> str:
    """arrivals: the clicks as they come, with ``late``: at or before the watermark that filters their batch. It follows the newest event of all batches up to ``back`` before."""
    file = _FILE.replace("unix_micros", "epoch_us").replace(" div ", " // ")
    return f"""{clicks_ms or _CLICKS_MS}, came as (select *, {file} as file from clicks), tops as (select file, max(event_ts) as top from came group by file),
marks as (select file, max(top) over (order by file rows between unbounded preceding and {back} preceding) - interval '{delay_s} seconds' as mark from tops),
arrivals as (select c.*, coalesce(c.event_ts <= m.mark, false) as late from came c join marks m using (file)), kept as (select * exclude (file, late) from arrivals where not late)"""


def _kept_sessions_sql(gap: str) -> str:
    return _sessions_sql(gap).replace("from clicks", "from kept")


_SWEEP = (("2 minutes", 120, "6 hours"), ("10 seconds", 10, "1 day"), ("1 day", 86_400, "6 hours"))


@_query("watermark_sweep", " union all ".join(f"""select * from (with {_late_sql(s)}, {_kept_sessions_sql(g)} select '{w}' as watermark, '{g}' as gap, (select count(*) + 1 from arrivals) as input_rows, count(*) as sessions, sum(event_count)::bigint as events,
  0::bigint as dropped_by_window, (select count(*) from arrivals where late) as dropped_by_dedupe, 1 + (select count(distinct event_id) from kept where event_ts + interval '{2 * s} seconds' > (select max(event_ts) from came) + interval '72 hours') as dedupe_state_rows from s)""" for w, s, g in _SWEEP))
def _(spark, d):
    """Runs over files of which some events come too late, one file a batch."""
    shards = _late_shards(spark, d)
    return sweeps.watermark_sweep(lambda: read_file_stream(spark, shards, 1), tuple((w, g) for w, _, g in _SWEEP), shared_folder(spark, "watermarks"), WIN)


def _drops_sql(back: int) -> str:
    return f"with {_late_sql(120, back)} select 'dedupeWithinWatermark' as operator, count(*) filter (late) as dropped, 1::bigint as state_rows from arrivals union all select 'sessionWindowStateStoreSaveExec', 0, 1"


def _drops(spark, d, multiple: bool) -> DataFrame:
    got = progress.operators(progress.frame(spark, _late_run(spark, d, multiple)[1]))
    return got.select(F.col("operatorName").alias("operator"), "dropped", "state_rows")


@_query("operator_drops", _drops_sql(2))
def _(spark, d):
    """A batch is filtered by the watermark of the batch before it."""
    return _drops(spark, d, True)


@_query("operator_drops_same_batch", _drops_sql(1))
def _(spark, d):
    """As it is where only one stateful operator is allowed for: a batch is filtered by its own watermark."""
    return _drops(spark, d, False)


@_query("checkpoint_state", f"with {_late_sql(120)} select count(distinct file) + 1 as last_planned, count(distinct file) + 1 as last_committed, 0::int as uncommitted, count(distinct file) + 2 as next_batch from came")
def _(spark, d):
    """A batch for each file, one for the flush row, one more that closes what it leaves."""
    return recovery.checkpoint_state(spark, _late_run(spark, d)[0]).withColumn("uncommitted", F.size("uncommitted"))


@_query("source_offsets", f"with {_late_sql(120)}, n as (select count(distinct file) as files from came) select b::bigint as batch, 0::int as source, concat('{{\"logOffset\":', least(b, files), '}}') as offset from n, range(12) r(b) where b <= files + 1")
def _(spark, d):
    return recovery.source_offsets(spark, _late_run(spark, d)[0])


@_query("quarantined", f"with {CLICKS_SQL} select event_id, user_id, 'event_ts' as reason from clicks where cast(event_id as bigint) % 50 = 7 union all select null, null, 'document' from clicks where cast(event_id as bigint) % 71 = 3")
def _(spark, d):
    """Refused documents, after a stop between the sessions' sink and theirs."""
    folder, where = shared_folder(spark, "mixed"), shared_folder(spark, "two-sinks")
    broken = clicks(spark, d).where("cast(event_id as long) % 71 = 3").select(F.lit("not json").alias("value"))
    _lines(spark, d).unionByName(broken).write.text(folder)
    rows = job.pipeline_with_refused(read_file_stream(spark, folder), GAP, "2 minutes", WIN)
    table = upsert.SessionTable(spark, f"{where}/table", rows.select("session.*").schema)
    known = lambda: recovery.query_id(spark, f"{where}/cp")
    to_table = job.upsert_sink(table, query_id=known)
    aside = job.refused_sink(spark, f"{where}/refused", known)
    try:
        job.start(rows, f"{where}/cp", sink=job.both_sinks(job.Stopping(to_table, 0, "after-merge"), aside)).awaitTermination()
    except StreamingQueryException:
        pass  # the planned stop
    job.start(rows, f"{where}/cp", sink=job.both_sinks(to_table, aside)).awaitTermination()
    field = lambda name: F.get_json_object("value", f"$.{name}").alias(name)
    return job.read_refused(spark, f"{where}/refused").select(field("event_id"), field("user_id"), "reason")


@_query("batch_latency")
def _(spark, d):
    return progress.batch_latency(progress.frame(spark, _late_run(spark, d)[1]))


def _unflushed(spark, d) -> str:
    """The checkpoint of a run that ends with its input: what the watermark hasn't passed stays open."""
    folder, cp = shared_folder(spark, "open"), shared_folder(spark, "checkpoint")
    to_json_lines(clicks(spark, d)).write.text(folder)
    job.start(job.pipeline(read_file_stream(spark, folder), GAP, "2 minutes", WIN), cp, out=shared_folder(spark, "sessions")).awaitTermination()
    return cp


_MARK = "(select max(event_ts) - interval '2 minutes' from clicks)"


@_query("open_sessions", f"with {_CLICKS_MS}, {_sessions_sql(GAP)} select user_id, epoch_us(session_start) as session_start_us, epoch_us(session_end) as session_end_us, event_count from s where session_end > {_MARK}")
def _(spark, d):
    held = recovery.open_sessions(spark, _unflushed(spark, d))
    return held.select("user_id", F.unix_micros("session_start").alias("session_start_us"), F.unix_micros("session_end").alias("session_end_us"), "event_count")


@_query("remembered_events", f"with {_CLICKS_MS}, {_dedupe()} select event_id, epoch_us(event_ts) + 120000000 as expires_us from d where event_ts + interval '2 minutes' > {_MARK}")
def _(spark, d):
    return recovery.remembered_events(spark, _unflushed(spark, d))


#: name, kind and SQL of the figures that are taken once from the clicks and once, without repeated events, from their wire form.
_FIGURES = (("events", "counted", "count(*)"), ("different_events", "counted", "count(distinct event_id)"), ("users", "counted", "count(distinct user_id)"), ("visits", "counted", "count(distinct session_hint)"), ("late_s", "timing", "sum({late}) / 1e6"))


def _figures_sql(rows: str, late: str) -> str:
    return " union all ".join(f"select '{name}' as name, ({sql.format(late=late)})::double as v from {rows}" for name, _, sql in _FIGURES)


@_query("reproduction_report", f"""{_W}{_dedupe()}, wire as (select * replace (date_trunc('milliseconds', event_ts) as event_ts, date_trunc('milliseconds', ingest_ts) as ingest_ts) from d),
f as (select p.v as published, m.v as measured, p.name in ({", ".join(f"'{n}'" for n, k, _ in _FIGURES if k == "counted")}) as counted from ({_figures_sql("clicks", _LAG)}) p join ({_figures_sql("wire", _LAG)}) m using (name))
select count(*) filter (published = measured) as reproduced, count(*) filter (published != measured and counted) as differs, count(*) filter (published != measured and not counted) as moved from f""")
def _(spark, d):
    """Figures of all clicks against those of the deduplicated events as the parser reads them: repeated events must show, the rest must not."""
    c = clicks(spark, d)
    late = "unix_micros(ingest_ts) - unix_micros(event_ts)"

    def figures(rows: DataFrame, side: str) -> DataFrame:
        one = rows.agg(*[F.expr(f"cast({sql.format(late=late)} as double)").alias(name) for name, _, sql in _FIGURES])
        return one.unpivot([], [name for name, *_ in _FIGURES], "name", side)

    kind = F.create_map(*[F.lit(x) for name, k, _ in _FIGURES for x in (name, k)])
    both = figures(c, "published").join(figures(S.dedupe(parse(to_json_lines(c))), "measured"), "name")
    return repro.report(both.select("name", "published", "measured", kind[F.col("name")].alias("kind")))


def queries():
    return {name: f for name, (f, _) in _Q.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _Q.items() if sql}


__all__ = ["oracle_sql", "queries", "seconds_between"]
