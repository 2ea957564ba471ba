"""Clickstream rows over the ``events`` test table, written once for Spark and once for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_BODY = """
with base as (
  select event_id as n, concat('u_', user_id) as user_id, event_type, {ts} as event_ts,
    cast(regexp_extract(props, '([0-9]+)', 1) as int) as k,
    concat('s_', user_id, '_', sum(case when event_type = 'signup' then 1 else 0 end)
      over (partition by user_id order by ts, event_id rows unbounded preceding)) as session_hint
  from {events}
), rows_once as (
  select n, {string_n} as event_id, user_id, session_hint, event_type, concat('/p/', k % 10) as page, event_ts,
    {add_k} as ingest_ts
  from base
)
select event_id, user_id, session_hint, event_type, page, event_ts, ingest_ts from rows_once
union all
select event_id, user_id, session_hint, event_type, page, event_ts, {add_3} as ingest_ts from rows_once where n % 100 = 0
"""
_SPARK = _BODY.format(ts="cast(ts as timestamp)", events="{events}", string_n="cast(n as string)", add_k="event_ts + make_interval(0, 0, 0, 0, 0, 0, case when n % 20 = 0 then k else 0 end)", add_3="ingest_ts + interval 3 seconds")
#: ``clicks`` for DuckDB, to stand first in a WITH list.
CLICKS_SQL = "clicks as (" + _BODY.format(ts="ts", events="events", string_n="cast(n as varchar)", add_k="event_ts + to_seconds(case when n % 20 = 0 then k else 0 end)", add_3="ingest_ts + interval 3 seconds") + ")"


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_SPARK.format(events="{events}"), events=spark.read.parquet(f"{sf_dir}/events.parquet"))
