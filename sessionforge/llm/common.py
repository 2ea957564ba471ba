"""Shared plumbing: written intermediate tables, importable workers and text chunks."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOT = Path(__file__).resolve().parents[2]


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or one of our own where it is unset on a local master (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file:///tmp/checkpoints/sessionforge"
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


#: Rows of whole texts that go to a Python worker at once. Spark's 10,000 would hold tens of megabytes for each task on both sides.
TEXT_ROWS = 500
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, name: str, texts: bool = False) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends here, so a lost executor costs one stage and not the job.

    The table goes when the application ends, or with ``forget``. ``texts`` says that whole texts pass through Python on the way.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/sessionforge-{uuid.uuid4().hex}/{name}"
    usual = spark.conf.get(_BATCH)
    if texts:
        spark.conf.set(_BATCH, str(min(TEXT_ROWS, int(usual)) if int(usual) > 0 else TEXT_ROWS))
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_BATCH, usual)
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = hadoop
    return table


def forget(*tables: DataFrame) -> None:
    """Deletes tables of ``written`` from which nothing will be read again."""
    for t in tables:
        t.written_to.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(t.written_to, True)


def split_by(rows: DataFrame, key: list[str], keys: DataFrame, words: int = 1 << 19) -> tuple[DataFrame, DataFrame]:
    """(rows that may have a key of ``keys``, rows that surely have none); both have the columns ``key``.

    A bitmap of the keys' hashes, ``words`` times 64 bits at most, is broadcast, so that the rows' other columns need no shuffle
    where few have such a key. With very many keys more rows may have one.
    """
    h = F.xxhash64(*key)
    word, bit = F.pmod(h, F.lit(words)), F.shiftright(h, 40).bitwiseAND(F.lit(63)).cast("int")
    at = lambda t: t.select("*", word.alias("_word"), bit.alias("_bit"))
    bits = at(keys.select(*key)).groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    both = at(rows).join(F.broadcast(bits), "_word", "left").withColumn("_maybe", F.expr("coalesce(shiftright(_bits, _bit) & 1L, 0L) = 1L"))
    return both.where("_maybe").select(*rows.columns), both.where("not _maybe").select(*rows.columns)


def ensure_importable(spark: SparkSession) -> None:
    """Ships this package to Python workers that would not find it (neither on PYTHONPATH nor in the working folder)."""
    sc = spark.sparkContext
    if str(_ROOT) in os.environ.get("PYTHONPATH", "").split(":") or Path.cwd().resolve() == _ROOT or (Path.cwd() / "sessionforge").exists():
        return
    if getattr(sc, "_sessionforge_shipped", False):
        return
    target = Path(tempfile.mkdtemp()) / "sessionforge.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in (_ROOT / "sessionforge").rglob("*.py"):
            z.write(f, f.relative_to(_ROOT))
    sc.addPyFile(str(target))
    sc._sessionforge_shipped = True


#: Bytes of text that a worker encodes at once.
SLICE = 2_000_000


def slices(column, limit: int = SLICE):
    """(a, b, texts): the rows of a text column a few megabytes at a time, so that a worker's memory follows neither rows nor batches."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    a = 0
    while a < len(column):
        b = max(int(np.searchsorted(ends, (ends[a - 1] if a else 0) + limit, "right")), a + 1)
        yield a, b, column.slice(a, b - a).to_pylist()
        a = b
        give_back()


def give_back() -> None:
    """Returns freed memory to the system: workers are reused by later stages, and what one has freed should not add to what the next needs."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def coded(texts: list[str], mark: str):
    """(codes, bounds, words): the parts of ``texts`` between ``mark`` as numbers into ``words``; text i has codes[bounds[i]:bounds[i+1]]."""
    import pyarrow as pa
    import pyarrow.compute as pc

    parts = pc.split_pattern(pa.array(texts, pa.large_string()), mark)
    flat = parts.flatten().dictionary_encode()
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False), out=bounds[1:])
    return flat.indices.to_numpy(), bounds, flat.dictionary.to_numpy(zero_copy_only=False).tolist()


def spread(codes: np.ndarray, pieces: list[bytes], dtype) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ends): the numbers in ``pieces`` for each code in turn, and where each code's numbers end."""
    dtype = np.dtype(dtype)
    size = np.fromiter(map(len, pieces), np.int64, len(pieces)) // dtype.itemsize
    start = np.cumsum(size) - size
    flat = np.frombuffer(b"".join(pieces), dtype)
    own = size[codes]
    ends = np.cumsum(own)
    small = np.int32 if max(len(flat), ends[-1] if len(ends) else 0) < 1 << 31 else np.int64
    at = np.repeat((start[codes] - (ends - own)).astype(small), own)
    at += np.arange(len(at), dtype=small)
    return flat[at], ends
