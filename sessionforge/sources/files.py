"""Event sources (JSON lines, Kafka, Parquet) and small writers on Hadoop file systems."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionforge.schema import EVENT_SCHEMA, TS_PATTERN, cast_times

FLUSH_USER, FLUSH_FILE = "u_flush0", "zzz-flush.json"


def read_file_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Raw lines as they arrive; no number of files means no limit."""
    reader = spark.readStream.format("text")
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).load(path)


def read_kafka_stream(spark: SparkSession, brokers: str, topic: str, starting: str = "earliest", max_offsets: int | None = None) -> DataFrame:
    """Needs the Kafka connector on the class path; without it Spark says so here."""
    if not brokers or not topic:
        raise ValueError("Kafka needs brokers and a topic")
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers).option("subscribe", topic).option("startingOffsets", starting)
    return (reader.option("maxOffsetsPerTrigger", max_offsets) if max_offsets else reader).load()


def read_kafka_back(spark: SparkSession, brokers: str, topic: str) -> DataFrame:
    """user_id and partition of every record from the beginning to the present end of each partition."""
    if not brokers or not topic:
        raise ValueError("Kafka needs brokers and a topic")
    got = spark.read.format("kafka").option("kafka.bootstrap.servers", brokers).option("subscribe", topic).option("startingOffsets", "earliest").option("endingOffsets", "latest").load()
    return got.select(F.col("key").cast("string").alias("user_id"), "partition")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Typed events of a folder of JSON lines, by the declared schema and the shared parser."""
    return cast_times(spark.read.schema(EVENT_SCHEMA).json(path))


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def max_event_ts(spark: SparkSession, path: str):
    """The newest event time over all shards; an empty folder is an error."""
    top = read_events(spark, path).agg(F.max("event_ts")).first()[0]
    if top is None:
        raise ValueError(f"no events in {path}")
    return top


def to_json_lines(events: DataFrame) -> DataFrame:
    """``value``: each event as one compact JSON document with the wire's timestamp format."""
    wire = [F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias(c) if c in ("event_ts", "ingest_ts") and dict(events.dtypes)[c].startswith("timestamp") else F.col(c) for c in events.columns if c in EVENT_SCHEMA.names]
    return events.select(F.to_json(F.struct(*wire)).alias("value"))


def write_events(events: DataFrame, sink: str = "jsonl", *, path: str | None = None, brokers: str | None = None, topic: str | None = None) -> None:
    """jsonl (text files), null (noop), memory (a temporary view ``generated_events``), kafka (keyed by user) or stdout."""
    lines = to_json_lines(events)
    if sink == "jsonl":
        lines.write.mode("append").text(path)
    elif sink == "null":
        lines.write.format("noop").mode("overwrite").save()
    elif sink == "memory":
        lines.createOrReplaceTempView("generated_events")
    elif sink == "stdout":
        lines.show(20, truncate=False)
    elif sink == "kafka":
        if not brokers or not topic:
            raise ValueError("Kafka needs brokers and a topic")
        keyed = events.select(F.col("user_id").alias("key"), F.to_json(F.struct(*[c for c in events.columns if c in EVENT_SCHEMA.names])).alias("value"))
        keyed.write.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic).save()
    else:
        raise ValueError(f"unknown sink {sink!r}")


class Files:
    """Small files by Hadoop, so that any store Spark reads works."""

    def __init__(self, spark: SparkSession, folder: str):
        jvm = spark.sparkContext._jvm
        self._jvm, self.folder = jvm, folder.rstrip("/")
        self._path = jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, sub: str = "") -> list[str]:
        at = self._path(f"{self.folder}/{sub}")
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._path(f"{self.folder}/{name}"))

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(f"{self.folder}/{name}"))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(f"{self.folder}/{name}"), True)

    def size(self, name: str) -> int:
        """Bytes of all files of a folder."""
        return self.fs.getContentSummary(self._path(f"{self.folder}/{name}")).getLength()

    def age_s(self, name: str) -> float:
        return time.time() - self.fs.getFileStatus(self._path(f"{self.folder}/{name}")).getModificationTime() / 1000

    def create(self, name: str, text: str) -> None:
        """A new file by one call that fails where the name is taken; on object stores it appears whole when it is closed."""
        to = self._path(f"{self.folder}/{name}")
        self.fs.mkdirs(to.getParent())
        try:
            out = self.fs.create(to, False)
        except Exception as e:
            if self.fs.exists(to):
                raise FileExistsError(str(to)) from e
            raise
        out.write(bytearray(text.encode()))
        out.close()

    def write(self, name: str, text: str) -> None:
        """A new file, whole or not at all: written beside and renamed. A name that is taken is an error, as no store can replace a file safely."""
        beside, to = self._path(f"{self.folder}/.{name.replace('/', '-')}.tmp"), self._path(f"{self.folder}/{name}")
        if self.fs.exists(to):
            raise FileExistsError(str(to))
        out = self.fs.create(beside, True)
        out.write(bytearray(text.encode()))
        out.close()
        self.fs.mkdirs(to.getParent())
        if not self.fs.rename(beside, to):
            raise OSError(f"could not put {name} in place")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder of this run in the place that all executors share: ``spark.checkpoint.dir``, or one of our own where it is unset on a local master."""
    root, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
    if not root and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{(root or 'file:///tmp/checkpoints/sessionforge').rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` by way of a table in the shared folder, for what is read more than once; it goes when the application ends."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    files = Files(spark, path)
    files.fs.deleteOnExit(files._path(path))
    return spark.read.schema(df.schema).parquet(path)


def write_flush(spark: SparkSession, path: str, hours: float = 72.0) -> None:
    """One event of a user of its own, ``hours`` after the newest, in a file that sorts last: it moves the watermark past every open session."""
    row = spark.range(1).select(
        F.lit("flush").alias("event_id"), F.lit(FLUSH_USER).alias("user_id"), F.lit("flush").alias("event_type"),
        F.lit(max_event_ts(spark, path)).cast("timestamp").alias("t"),
    ).withColumn("event_ts", F.timestamp_micros(F.unix_micros("t") + int(hours * 3.6e9))).withColumn("ingest_ts", F.col("event_ts"))
    Files(spark, path).write(FLUSH_FILE, to_json_lines(row.drop("t")).first().value + "\n")


__all__ = [n for n in dir() if n.startswith(("read_", "write_", "to_", "max_")) or n in ("Files", "TS_PATTERN", "shared_folder", "staged")]
