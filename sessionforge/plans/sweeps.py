"""Sweeps over gap and watermark, and the replay matrix: whole runs compared."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionforge.functions.durations import emission_floor
from sessionforge.operators.scoring import scorecard, without_sentinel
from sessionforge.operators.sessions import build_batch, dedupe, split_sessions
from sessionforge.operators.upsert import Drift, SessionTable, fingerprint
from sessionforge.sources.files import Files, staged
from sessionforge.streaming.job import Stopping, pipeline, start, upsert_sink
from sessionforge.streaming.progress import frame, operators, watched
from sessionforge.streaming.recovery import checkpoint_state, compare, last_committed, query_id, replay_scope

SWEEP = "gap string, floor_s double, recovered long, merged long, boundaries_lost long, split long, boundary_miss_rate double, split_rate double"
ARMS = ("clean", "crash-after", "crash-before", "fresh-checkpoint", "wiped-table")


def gap_sweep(events: DataFrame, gaps, watermark: str = "2 minutes", conversion: str = "checkout") -> DataFrame:
    """One row for each gap: its floor and its scorecard, from one deduplicated input."""
    once = staged(dedupe(events), "once")
    rows = []
    for gap in gaps:
        card = scorecard(events, split_sessions(once, gap, conversion))
        rows.append(card.select(F.lit(gap).alias("gap"), F.lit(emission_floor(gap, watermark)).alias("floor_s"), "recovered", "merged", "boundaries_lost", "split", "boundary_miss_rate", "split_rate"))
    return reduce(DataFrame.unionByName, rows)


def resumable_gap_sweep(events: DataFrame, gaps, results: str, watermark: str = "2 minutes", conversion: str = "checkout") -> DataFrame:
    """The sweep, with a file of one JSON line for each gap under ``results``; gaps that are there already are not run again. Gives all gaps found there."""
    gaps, spark = list(gaps), events.sparkSession
    if not gaps:
        raise ValueError("no gaps asked for")
    files = Files(spark, results)
    done = {r.gap for r in sweep_results(spark, results).select("gap").collect()}
    for gap in gaps:
        if gap not in done:
            row = gap_sweep(events, [gap], watermark, conversion).first().asDict()
            files.write(f"gap-{gap.replace(' ', '-')}.jsonl", json.dumps(row) + "\n")
    return sweep_results(spark, results)


def sweep_results(spark: SparkSession, results: str) -> DataFrame:
    """What a resumable sweep has found so far; an empty table before its first result."""
    if not any(n.endswith(".jsonl") for n in Files(spark, results).names()):
        return spark.createDataFrame([], SWEEP)
    return spark.read.schema(SWEEP).json(f"{results}/*.jsonl")


def watermark_sweep(raw, combos, folder: str, conversion: str = "checkout") -> DataFrame:
    """One row for each (watermark, gap), a streaming run with a checkpoint of its own: input rows, sessions and their events, rows that the session window and dedupe dropped as late, ids that dedupe holds at the end. ``raw()`` opens the stream."""
    out = []
    for i, (watermark, gap) in enumerate(combos):
        stream = pipeline(raw(), gap, watermark, conversion)
        spark = stream.sparkSession
        _, batches = watched(spark, lambda: start(stream, f"{folder}/cp{i}", out=f"{folder}/out{i}"))  # noqa: B023
        progress = frame(spark, batches)
        rows = without_sentinel(spark.read.schema(stream.schema).parquet(f"{folder}/out{i}"))
        got = rows.agg(F.count(F.lit(1)).alias("sessions"), F.coalesce(F.sum("event_count"), F.lit(0)).alias("events"))
        of = lambda name, what: F.coalesce(F.sum(F.when(F.col("operatorName").rlike(f"(?i){name}"), F.col(what))), F.lit(0))
        late = operators(progress).agg(of("sessionWindow", "dropped").alias("dropped_by_window"), of("dedupe", "dropped").alias("dropped_by_dedupe"), of("dedupe", "state_rows").alias("dedupe_state_rows"))
        read = progress.agg(F.coalesce(F.sum("numInputRows"), F.lit(0)).alias("input_rows"))
        out.append(read.crossJoin(got).crossJoin(late).select(F.lit(watermark).alias("watermark"), F.lit(gap).alias("gap"), "*"))  # three single rows
    return reduce(DataFrame.unionByName, out)


def replay_arm(spark: SparkSession, raw, folder: str, arm: str, batch: int = 1, gap: str = "30 minutes") -> dict:
    """One arm: a run, its stop or repetition, and the table's fingerprint. ``wiped-table`` must stop on drift."""
    if arm not in ARMS:
        raise ValueError(f"unknown arm {arm!r}")
    stream = pipeline(raw(), gap)
    table, cp = SessionTable(spark, f"{folder}/table", stream.schema), f"{folder}/cp"
    sink = upsert_sink(table, query_id=lambda: query_id(spark, cp))
    first = Stopping(sink, batch, {"crash-after": "after-merge", "crash-before": "before-merge"}[arm]) if arm.startswith("crash") else sink
    query = start(stream, cp, sink=first)
    try:
        query.awaitTermination()
    except Exception:
        if not arm.startswith("crash"):
            raise
    at_crash = (table.current() or {"rows": 0})["rows"]
    before = checkpoint_state(spark, cp).first().asDict()
    if arm == "wiped-table":
        for part in ("pointers", "data", "trees", "leaves"):
            table.files.delete(part)
    if arm == "fresh-checkpoint":
        cp = f"{folder}/cp2"
    if arm != "clean":
        table.refuse_drift(last_committed(spark, cp), query_id(spark, cp))
        start(pipeline(raw(), gap), cp, sink=sink).awaitTermination()
    after = checkpoint_state(spark, cp).first().asDict()
    return {"arm": arm, "rows_at_crash": at_crash, "rows": table.current()["rows"], "fingerprint": fingerprint(table.read()).first()[0], **replay_scope(before, after)}


def replay_matrix(spark: SparkSession, raw, folder: str, gap: str = "30 minutes") -> DataFrame:
    """(arm, verdict, rows) of all arms: identical to ``clean`` or in what it differs, REFUSED where a start was stopped on drift."""
    ran = []
    for arm in ARMS:
        try:
            ran.append(replay_arm(spark, raw, f"{folder}/{arm}", arm, gap=gap))
        except Drift:
            ran.append({"arm": arm, "fingerprint": None, "rows": None})
    by = {a["arm"]: a["rows"] for a in ran}
    return spark.createDataFrame([(r["arm"], r["verdict"], by[r["arm"]]) for r in replay_report(ran)], "arm string, verdict string, rows long")


def replay_report(arms: list[dict]) -> list[dict]:
    """Each arm against ``clean``; an arm that is missing, or was stopped on drift, is said to be so."""
    by = {a["arm"]: a["fingerprint"] for a in arms}
    said = lambda n: "NOT RUN" if n not in by or "clean" not in by else "REFUSED" if by[n] is None else compare(by["clean"], by[n])
    return [{"arm": n, "verdict": said(n)} for n in ARMS]


__all__ = ["ARMS", "build_batch", "gap_sweep", "replay_arm", "replay_report", "resumable_gap_sweep", "sweep_results", "watermark_sweep"]
