"""Query progress as DataFrames: a listener that keeps every batch, batch latency, late-drop accounting."""

from __future__ import annotations

import json
from threading import Condition

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from sessionforge.sources.files import Files

SCHEMA = "batchId long, numInputRows long, durationMs map<string, long>, stateOperators array<struct<operatorName: string, numRowsTotal: long, memoryUsedBytes: long, numRowsDroppedByWatermark: long, customMetrics: map<string, long>>>, observedMetrics struct<parsed: struct<rows: long, refused: long>>"


class Progress(StreamingQueryListener):
    """Keeps the progress of all batches of every run; ``recentProgress`` forgets all but the last hundred."""

    def __init__(self):
        self._batches: dict[str, list[str]] = {}
        self._ended: set[str] = set()
        self._told = Condition()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        with self._told:
            self._batches.setdefault(str(event.progress.runId), []).append(event.progress.json)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self._told:
            self._ended.add(str(event.runId))
            self._told.notify_all()

    def wait(self, query, seconds: float = 60) -> None:
        """Events come in order, but later than the end of their query: its own end is waited for."""
        run = str(query.runId)
        with self._told:
            if not self._told.wait_for(lambda: run in self._ended, seconds):
                raise TimeoutError(f"the end of run {run} was not told within {seconds} seconds")

    def of(self, query, seconds: float = 60) -> list[str]:
        """All batches of a query that has ended."""
        self.wait(query, seconds)
        return list(self._batches.get(str(query.runId), []))


class ProgressLog(Progress):
    """Appends every batch to ``<folder>/<run>/<batch>.json`` and keeps none in memory; ``history`` reads what all runs have left.

    After ``many`` files of a run these become one. They go only when that one stands, so a stop between leaves a batch twice, which readers see once.
    """

    def __init__(self, spark: SparkSession, folder: str, many: int = 128):
        super().__init__()
        self.folder, self.many, self._files = folder.rstrip("/"), many, Files(spark, folder)
        self._loose: dict[str, int] = {}
        self._last: dict[str, int] = {}

    def onQueryProgress(self, event):
        run, batch = str(event.progress.runId), int(event.progress.batchId)
        if self._last.get(run) == batch:  # told again while nothing new came
            return
        self._files.write(f"{run}/{batch:012d}.json", event.progress.json + "\n")
        self._last[run], self._loose[run] = batch, self._loose.get(run, 0) + 1
        if self._loose[run] >= self.many:
            single = [n for n in self._files.names(run) if n.endswith(".json")]
            self._files.write(f"{run}/upto-{batch:012d}.jsonl", "".join(self._files.read(f"{run}/{n}") for n in single))
            for n in single:
                self._files.delete(f"{run}/{n}")
            self._loose[run] = 0

    def onQueryTerminated(self, event):
        for held in (self._loose, self._last):
            held.pop(str(event.runId), None)
        super().onQueryTerminated(event)


def watched(spark: SparkSession, begin) -> tuple:
    """(query, its batches): starts the query by ``begin()`` and follows it to its end."""
    seen = Progress()
    spark.streams.addListener(seen)
    try:
        query = begin()
        query.awaitTermination()
        return query, seen.of(query)
    finally:
        spark.streams.removeListener(seen)


def frame(spark: SparkSession, batches: list[str]) -> DataFrame:
    """One row for each batch, from progress documents."""
    return spark.createDataFrame([(b if isinstance(b, str) else json.dumps(b),) for b in batches], "value string").select(F.from_json("value", SCHEMA).alias("p")).select("p.*")


def history(spark: SparkSession, folder: str, after: int = -1) -> DataFrame:
    """One row for each run and batch beyond ``after`` of all runs that logged to ``folder``: the columns of ``frame``, query, runId and the document itself."""
    head = "id string, runId string"
    if not Files(spark, folder).names():
        return spark.createDataFrame([], f"value string, query string, runId string, {SCHEMA}")
    lines = spark.read.option("recursiveFileLookup", "true").text(folder)
    read = lines.select("value", F.from_json("value", f"{head}, {SCHEMA}").alias("p")).select("value", F.col("p.id").alias("query"), "p.*").drop("id")
    return read.where(F.col("batchId") > after).dropDuplicates(["runId", "batchId"])


def batch_latency(progress: DataFrame) -> DataFrame:
    """Batches, rows, the first batch against the rest, addBatch quantiles and rows a second."""
    add, total = F.col("durationMs")["addBatch"], F.col("durationMs")["triggerExecution"]
    rows = progress.select("batchId", "numInputRows", add.alias("add"), total.alias("total"))
    return rows.agg(
        F.count(F.lit(1)).alias("batches"), F.sum("numInputRows").alias("rows"), F.min_by("total", "batchId").alias("first_ms"),
        F.avg(F.when(F.col("batchId") > 0, F.col("total"))).alias("rest_ms"), F.percentile("add", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99))).alias("add_ms"),
        F.try_divide(F.sum("numInputRows") * 1000.0, F.sum("total")).alias("rows_a_second"),
    )


def operators(progress: DataFrame) -> DataFrame:
    """For each stateful operator: rows dropped by the watermark in all, and state as the last batch left it. Never summed over operators."""
    each = progress.select("batchId", F.posexplode("stateOperators").alias("position", "op")).select("batchId", "position", "op.*")
    return each.groupBy("position", "operatorName").agg(F.sum("numRowsDroppedByWatermark").alias("dropped"), F.max_by("numRowsTotal", "batchId").alias("state_rows"), F.max_by("memoryUsedBytes", "batchId").alias("state_bytes"))


def session_operator(progress: DataFrame) -> DataFrame:
    """The session window's row; an error if no operator plays that part."""
    got = operators(progress).where(F.col("operatorName").rlike("(?i)sessionWindow"))
    if got.isEmpty():
        raise ValueError("no session window among the stateful operators")
    return got


def refused_rows(progress: DataFrame) -> DataFrame:
    """parsed and refused rows over all batches."""
    seen = F.col("observedMetrics.parsed")
    return progress.agg(F.coalesce(F.sum(seen["rows"]), F.lit(0)).alias("parsed_rows"), F.coalesce(F.sum(seen["refused"]), F.lit(0)).alias("refused_rows"))
