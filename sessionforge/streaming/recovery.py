"""What a checkpoint says: planned and committed batches, source positions, what a restart will do, and verdicts on replays."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionforge.sources.files import Files


def _batches(files: Files, log: str) -> list[int]:
    return sorted(int(n) for n in files.names(log) if n.isdigit())  # .crc and temporary files are no batches


class BrokenCheckpoint(ValueError):
    """There is no checkpoint where one should be read, or it is damaged."""


def checkpoint_state(spark: SparkSession, path: str) -> DataFrame:
    """One row: last planned and committed batch, planned but not committed ones, the next batch, which is the first of these. Logs keep a bounded number of batches.

    A folder without planned batches is refused: it must not pass for a run that has nothing left to do.
    """
    files = Files(spark, path)
    planned, committed = _batches(files, "offsets"), _batches(files, "commits")
    if not planned:
        raise BrokenCheckpoint(f"no planned batches under {path}")
    open_ones = sorted(set(planned) - set(committed))
    row = (max(planned), max(committed, default=None), open_ones, min(open_ones, default=max(planned) + 1))
    return spark.createDataFrame([row], "last_planned long, last_committed long, uncommitted array<long>, next_batch long")


def last_committed(spark: SparkSession, path: str) -> int | None:
    """None where there is no checkpoint yet."""
    return max(_batches(Files(spark, path), "commits"), default=None)


def query_id(spark: SparkSession, path: str) -> str | None:
    """The id of the query that a checkpoint belongs to; None where there is no checkpoint yet."""
    files = Files(spark, path)
    return json.loads(files.read("metadata"))["id"] if files.exists("metadata") else None


def source_offsets(spark: SparkSession, path: str, batch: int | None = None) -> DataFrame:
    """(batch, source, offset): the sources' positions as each batch, or the one asked for, planned them. What can't be read is an error."""
    files, rows = Files(spark, path), []
    planned = _batches(files, "offsets")
    if not planned or batch is not None and batch not in planned:
        raise BrokenCheckpoint(f"no planned batch {'' if batch is None else batch} under {path}")
    for b in planned if batch is None else [batch]:
        head, *lines = [x for x in files.read(f"offsets/{b}").splitlines() if x.strip()] or [""]
        if not head.startswith("v") or not lines:
            raise BrokenCheckpoint(f"offsets/{b} has no version or no metadata")
        for i, line in enumerate(lines):
            try:
                json.loads(line)
            except ValueError as e:
                raise BrokenCheckpoint(f"offsets/{b}, line {i + 2}: {e}") from e
        rows += [(b, i, line) for i, line in enumerate(lines[1:])]
    return spark.createDataFrame(rows, "batch long, source int, offset string")


def _state(spark: SparkSession, path: str, part: str) -> DataFrame:
    """What the state store of the operator whose name has ``part`` held after the last committed batch; read by Spark's own reader, one task a partition of the state."""
    found = spark.read.format("state-metadata").load(path).where(F.lower("operatorName").contains(part.lower())).select("operatorId").distinct().collect()
    if len(found) != 1:
        raise BrokenCheckpoint(f"{len(found)} operators named like {part!r} under {path}")
    return spark.read.format("statestore").option("operatorId", found[0].operatorId).load(path)


def open_sessions(spark: SparkSession, path: str) -> DataFrame:
    """user_id, session_start, session_end and event_count of the sessions that a run has left open in its checkpoint."""
    held = F.col("value.session_window")
    return _state(spark, path, "sessionWindow").select(F.col("value.user_id").alias("user_id"), held["start"].alias("session_start"), held["end"].alias("session_end"), F.col("value.count").alias("event_count"))


def remembered_events(spark: SparkSession, path: str) -> DataFrame:
    """event_id and expires_us of the events whose copies a run would still refuse."""
    return _state(spark, path, "dedupe").select(F.col("key.event_id").alias("event_id"), F.col("value.expiresAtMicros").alias("expires_us"))


def kafka_position(offset: str) -> dict[str, int]:
    """``topic:partition`` -> offset; empty for what isn't a Kafka position."""
    try:
        got = json.loads(offset)
    except ValueError:
        return {}
    if not isinstance(got, dict) or not all(isinstance(v, dict) for v in got.values()):
        return {}
    return {f"{topic}:{part}": int(at) for topic, parts in got.items() for part, at in parts.items()}


def replay_scope(before: dict, after: dict) -> dict:
    """Batches done again, batches that were new, where it resumed and finished, from two checkpoint states as dicts."""
    planned, new = before["last_planned"], after["last_committed"]
    added = list(range((-1 if planned is None else planned) + 1, (-1 if new is None else new) + 1))
    return {"redone": sorted(before["uncommitted"]), "added": added, "resumed_at": before["next_batch"], "finished_at": new}


def compare(expected: str, got: str) -> str:
    """identical, rows_gained, rows_lost or cells_differ, from two ``count:digest`` fingerprints."""
    if expected == got:
        return "identical"
    a, b = (int(x.split(":", 1)[0]) for x in (expected, got))
    return "rows_gained" if b > a else "rows_lost" if b < a else "cells_differ"
