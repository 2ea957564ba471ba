"""The engine's functions for queries written as SQL text: temporary SQL functions, which Spark expands into the plan, so nothing runs outside it."""

from __future__ import annotations

from pyspark.sql import SparkSession

from sessionforge.functions.durations import UNITS
from sessionforge.functions.partitioners import _M, _MASK, _SEED

_HEX = "hex(encode(k, 'UTF-8'))"
#: Little-endian words of four bytes, the last filled with zeros; one for each in ``w``.
_WORDS = f"transform(sequence(0, greatest((octet_length(k) + 3) div 4, 1) - 1), i -> cast(conv(concat_ws('', transform(array(6, 4, 2, 0), j -> substring(rpad({_HEX}, 8 * greatest((octet_length(k) + 3) div 4, 1), '0'), 8 * i + j + 1, 2))), 16, 10) as bigint))"
_TIMES = f"* {_M}L) & {_MASK}L"
_MIXED = f"transform(transform({_WORDS}, w -> (w {_TIMES}), w -> ((w ^ shiftrightunsigned(w, 24)) {_TIMES})"
_BODY = f"aggregate(slice({_MIXED}, 1, octet_length(k) div 4), ({_SEED}L ^ octet_length(k)) & {_MASK}L, (h, w) -> ((h {_TIMES}) ^ w)"
_TAIL = f"CASE WHEN octet_length(k) % 4 = 0 THEN {_BODY} ELSE (({_BODY} ^ element_at({_WORDS}, -1)) {_TIMES} END"
_MURMUR2 = f"element_at(transform(transform(array({_TAIL}), t -> ((t ^ shiftrightunsigned(t, 13)) {_TIMES}), z -> z ^ shiftrightunsigned(z, 15)), 1)"
_UNIT = " ".join(f"WHEN '{name}' THEN {float(s)}D" for name, s in UNITS.items())

#: name(arguments) RETURNS type, and what it returns.
FUNCTIONS = {
    "crc32_partition(k STRING, n INT) RETURNS INT": "CAST(crc32(encode(k, 'UTF-8')) % n AS INT)",
    "murmur2(k STRING) RETURNS BIGINT": _MURMUR2,
    "murmur2_partition(k STRING, n INT) RETURNS INT": "CAST((murmur2(k) & 2147483647L) % n AS INT)",
    "duration_seconds(t STRING) RETURNS DOUBLE": f"CAST(split_part(t, ' ', 1) AS DOUBLE) * CASE split_part(t, ' ', 2) {_UNIT} ELSE CAST(raise_error(concat('not a duration: ', t)) AS DOUBLE) END",
    "emission_floor(gap STRING, watermark STRING) RETURNS DOUBLE": "duration_seconds(gap) + duration_seconds(watermark)",
}


def register(spark: SparkSession) -> None:
    """The scalar functions, for this session."""
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")


def register_sessions(spark: SparkSession, view: str, name: str = "sessions_of") -> None:
    """The table function ``name(gap, conversion)``: the sessions of the view ``view`` of deduplicated events, with their features."""
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(gap STRING, conversion STRING)
RETURNS TABLE (user_id STRING, session_start TIMESTAMP, session_end TIMESTAMP, event_count BIGINT, page_depth BIGINT, duration_s DOUBLE, converted INT, bounce INT, window_span_s DOUBLE)
RETURN SELECT user_id, w.start, w.end, n, pages, us / 1e6D, won, IF(n = 1 AND pages = 1, 1, 0), (unix_micros(w.end) - unix_micros(w.start)) / 1e6D FROM (
  SELECT user_id, session_window(event_ts, g) AS w, count(*) AS n, CAST(size(collect_set(page)) AS BIGINT) AS pages, unix_micros(max(event_ts)) - unix_micros(min(event_ts)) AS us, max(IF(event_type = c, 1, 0)) AS won
  FROM (SELECT *, sessions_of.gap AS g, sessions_of.conversion AS c FROM {view}) GROUP BY user_id, session_window(event_ts, g))""".replace("sessions_of.", f"{name}."))
