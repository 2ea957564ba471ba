"""Keyed upsert on Parquet, merged on read: every batch is a run of its own, and of the rows of one key the one of the newest run counts.

A run is written once, clustered by the day of the key's time and sorted by key; nothing else is rewritten by a batch, whose cost follows the batch and the days it touches and
not the table. Readers merge only days that hold more than one run; a key has its day by itself, so all its rows meet there. Days in which runs have piled up are compacted after the batch: the newest
runs of such a day, as many as are not much larger than those after them together, become one (size tiers, so that a row is rewritten a logarithmic number of times).

Pointers ``<path>/pointers/<n>`` list the runs of every day; the newest counts. A pointer is created under a number that must be free, so of two writers
one fails with ``Conflict``. Runs lie in folders named by chance, which nobody else deletes: a writer removes only what the pointers that it retires named, and folders that no pointer has named for a day
(left by a crash). A pointer names query and batch, so a checkpoint ahead of the table, or one of another query, is noticed at start-up. A crash between any two steps leaves the table as the last pointer has it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from sessionforge.operators import digests
from sessionforge.schema import SESSION_COLUMNS, SESSION_KEY
from sessionforge.sources.files import Files

DAY_US = 86_400_000_000


class DuplicateKeys(ValueError):
    """A batch holds a key twice; nothing was written."""


class Conflict(RuntimeError):
    """Another writer has changed the table meanwhile; nothing was written."""


class Drift(RuntimeError):
    """The checkpoint has committed batches that the table doesn't hold."""


def duplicate_keys(rows: DataFrame, key=SESSION_KEY) -> DataFrame:
    return rows.groupBy(*key).count().where("count > 1")


def check_batch(rows: DataFrame, key=SESSION_KEY) -> None:
    """An empty batch is fine."""
    twice = duplicate_keys(rows, key).limit(1).collect()
    if twice:
        raise DuplicateKeys(str(twice[0].asDict()))


def accounting(target: DataFrame, batch: DataFrame, key=SESSION_KEY) -> DataFrame:
    """inserted and updated of a batch against the table before it."""
    known = target.select(*key).withColumn("known", F.lit(1))
    return batch.select(*key).join(known, list(key), "left").agg(F.count_if(F.col("known").isNull()).alias("inserted"), F.count("known").alias("updated"))


def fingerprint(rows: DataFrame, key=SESSION_KEY, depth: int = digests.DEPTH) -> DataFrame:
    """One row (fingerprint): count and digest over all columns but loaded_at, whatever the order of rows."""
    return digests.root(digests.leaves(rows, key, depth), depth).select(F.concat(F.col("rows").cast("string"), F.lit(":"), F.col("digest")).alias("fingerprint"))


class SessionTable:
    """Runs under ``<path>/data/<run>/day=<d>`` and pointers ``<path>/pointers/<n>``. ``key`` ends with the time by whose day rows are clustered."""

    #: So many runs of a day, none much larger than those after it together, become one.
    FAN = 4
    #: Seconds after which a run that no pointer names, or a pointer that isn't whole, was left by a crash.
    ORPHAN_S, TORN_S = 86_400, 60

    def __init__(self, spark: SparkSession, path: str, schema, key=SESSION_KEY):
        self.spark, self.path, self.key, self.files = spark, path.rstrip("/"), key, Files(spark, path)
        self.schema = schema if "loaded_at" in schema.names else StructType([*schema.fields, StructField("loaded_at", TimestampType())])
        self._stored = StructType([*self.schema.fields, StructField("_n", LongType())])

    def pointers(self) -> list[int]:
        return sorted(int(n) for n in self.files.names("pointers") if n.isdigit())

    def _pointer(self, n: int) -> dict | None:
        """None where its writer died while it wrote; one that may still be writing is waited for by no one."""
        try:
            return json.loads(self.files.read(f"pointers/{n}"))
        except ValueError:
            if self.files.age_s(f"pointers/{n}") < self.TORN_S:
                raise Conflict(f"version {n} of {self.path} is being written") from None
            return None

    def current(self) -> dict | None:
        return next((got for n in reversed(self.pointers()) if (got := self._pointer(n))), None)

    def _rows(self, days: dict[str, list[dict]]) -> DataFrame:
        """All rows of the runs of some days, each with the number ``_n`` of its run; a key may occur in several."""
        folders = [f"{self.path}/data/{run['run']}/day={day}" for day, runs in days.items() for run in runs]
        return self.spark.read.schema(self._stored).parquet(*folders) if folders else self.spark.createDataFrame([], self._stored)

    def _newest(self, days: dict[str, list[dict]]) -> DataFrame:
        """One row for each key. Days of one run need no shuffle."""
        many = {day: runs for day, runs in days.items() if len(runs) > 1}
        alone = self._rows({day: runs for day, runs in days.items() if len(runs) == 1})
        if not many:
            return alone
        rest = [c for c in self.schema.names if c not in self.key]
        last = self._rows(many).groupBy(*self.key).agg(F.max_by(F.struct(*rest, "_n"), "_n").alias("last")).select(*self.key, "last.*")
        return alone.unionByName(last)

    def read(self) -> DataFrame:
        return self._newest((self.current() or {"days": {}})["days"]).select(*self.schema.names)

    def _write(self, rows: DataFrame) -> tuple[str, dict[str, dict]]:
        """A new run: its name, and for each of its days the rows and bytes."""
        run = uuid.uuid4().hex
        day = F.expr(f"unix_micros({self.key[-1]}) div {DAY_US}")  # whatever the session's time zone
        rows = rows.withColumn("day", day)
        if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":  # not in a streaming batch, which has few days
            rows = rows.hint("rebalance", "day")
        rows.sortWithinPartitions("day", *self.key).write.partitionBy("day").parquet(f"{self.path}/data/{run}")
        found = self.spark.read.schema("day long").parquet(f"{self.path}/data/{run}").groupBy("day").agg(F.count(F.lit(1)).alias("n")).collect()
        if not found:
            self.files.delete(f"data/{run}")
        return run, {str(r.day): {"run": run, "rows": r.n, "bytes": self.files.size(f"data/{run}/day={r.day}")} for r in found}

    def apply(self, batch: DataFrame, query_id: str = "", batch_id: int = -1) -> dict:
        """Merges a batch; a repeated batch gives the same table. Returns inserted, updated and rows."""
        names = [c for c in self.schema.names if c != "loaded_at"]
        now = self.current() or {"n": 0, "rows": 0, "days": {}}
        n = max(self.pointers(), default=0) + 1
        run, wrote = self._write(batch.select(*names, F.current_timestamp().alias("loaded_at"), F.lit(n).cast("long").alias("_n")))
        try:
            own = self._rows({day: [r] for day, r in wrote.items()})
            check_batch(own, self.key)
            before = self._rows({day: now["days"][day] for day in wrote if day in now["days"]})
            counts = accounting(before.select(*self.key).distinct(), own, self.key).first()
            days = now["days"] | {day: [*now["days"].get(day, []), r] for day, r in wrote.items()}
            told = {"queryId": query_id, "batchId": batch_id, "rows": now["rows"] + counts.inserted}
            self._point({"n": n, "parent": now["n"], **told, "days": days})
        except Exception:
            self.files.delete(f"data/{run}")
            raise
        self._compact(n, told, days, wrote)
        self._tidy()
        return {"inserted": counts.inserted, "updated": counts.updated, "rows": told["rows"]}

    def _point(self, pointer: dict) -> None:
        """The commit: one new file under a number that must be free."""
        n = pointer["n"]
        try:
            self.files.create(f"pointers/{n}", json.dumps(pointer))
        except FileExistsError as e:
            raise Conflict(f"another writer has made version {n} of {self.path}") from e
        if any((later := self._pointer(m)) and later["parent"] < n for m in self.pointers() if m > n):
            raise Conflict(f"version {n} of {self.path} came too late")

    def _piled(self, runs: list[dict]) -> int:
        """How many of a day's newest runs to merge: 0, or the most of which each is at most FAN times as large as those after it together."""
        after, upto = runs[-1]["bytes"], 1
        for r in reversed(runs[:-1]):
            if r["bytes"] > self.FAN * after:
                break
            after, upto = after + r["bytes"], upto + 1
        return upto if upto >= self.FAN else 0

    def _compact(self, n: int, told: dict, days: dict[str, list[dict]], touched) -> None:
        due = {day: k for day in touched if (k := self._piled(days[day]))}
        if not due:
            return
        run, merged_days = self._write(self._newest({day: days[day][-k:] for day, k in due.items()}))
        rest = {day: [*days[day][: -due[day]], merged_days[day]] for day in due}
        self._point({"n": n + 1, "parent": n, **told, "days": days | rest})

    def _tidy(self) -> None:
        """Keeps the newest two pointers, since readers of the last version may still be at work; removes the runs that only older ones name, day by day."""
        known = {n: self._pointer(n) for n in self.pointers()}
        whole = [n for n, p in known.items() if p]
        named = lambda ns: {(r["run"], day) for n in ns for day, runs in known[n]["days"].items() for r in runs}
        kept, retired = named(whole[-2:]), named(whole[:-2])
        for run, day in retired - kept:
            self.files.delete(f"data/{run}/day={day}")
        held = {run for run, _ in kept}
        for run in {run for run, _ in retired} - held | {r for r in self.files.names("data") if r not in held and self.files.age_s(f"data/{r}") > self.ORPHAN_S}:
            self.files.delete(f"data/{run}")
        for n in known:
            if n < whole[-2:][0]:
                self.files.delete(f"pointers/{n}")

    def tree(self) -> DataFrame:
        """The table's digest tree. Leaves are kept by day, and only days whose runs have changed since the last call are read again."""
        days = (self.current() or {"days": {}})["days"]
        runs = {day: [r["run"] for r in held] for day, held in days.items()}
        made = sorted(int(n) for n in self.files.names("trees") if n.isdigit())
        last = json.loads(self.files.read(f"trees/{made[-1]}")) if made else {"runs": {}}
        same = [day for day, held in runs.items() if last["runs"].get(day) == held]
        rows = self._newest({day: held for day, held in days.items() if day not in set(same)}).drop("_n")
        sums = digests.leaves(rows.withColumn("day", F.expr(f"cast(unix_micros({self.key[-1]}) div {DAY_US} as string)")), self.key, digests.DEPTH, "day")
        if same:
            sums = sums.unionByName(self.spark.read.schema(sums.schema).parquet(f"{self.path}/leaves/{last['leaves']}").where(F.col("day").isin(same)))
        if len(same) < len(runs) or runs.keys() != last["runs"].keys():
            name = uuid.uuid4().hex
            sums.write.parquet(f"{self.path}/leaves/{name}")
            self.files.create(f"trees/{made[-1] + 1 if made else 1}", json.dumps({"runs": runs, "leaves": name}))
            for n in made[:-1]:  # the last but one may still be read
                self.files.delete(f"leaves/{json.loads(self.files.read(f'trees/{n}'))['leaves']}")
                self.files.delete(f"trees/{n}")
            sums = self.spark.read.schema(sums.schema).parquet(f"{self.path}/leaves/{name}")
        return digests.tree(sums)

    def refuse_drift(self, last_committed: int | None, query_id: str | None) -> None:
        """Stops where a checkpoint of the query ``query_id`` has committed batches but the table is gone, older or last written by another query."""
        now = self.current()
        if last_committed is None:
            return
        if now is None or now["batchId"] < last_committed:
            raise Drift(f"checkpoint has committed batch {last_committed}, the table holds {now and now['batchId']}")
        if now["queryId"] != query_id:
            raise Drift(f"checkpoint belongs to query {query_id}, the table was last written by {now['queryId']}")


COLUMNS = SESSION_COLUMNS
