"""The corpus pipeline: documents without toxic ones, without near copies, with secrets taken out, packed for training.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again for the next.
All but the last return the columns of ``documents``. A null text is kept (it is neither toxic nor a secret). Near-dedup
works by row, whatever its doc_id: of each class one row stays, rows with null doc_id come last, and different texts under one doc_id are different documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionforge.llm import near_copies, packing, secret_scan, toxicity
from sessionforge.llm.common import forget, split_by, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5; learned from the labels of the held-in rows."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep(docs.select(*COLUMNS), model)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies (five words, similarity 0.8): one with the smallest doc_id."""
    key = ("doc_id", "text_key")
    docs = docs.select(*COLUMNS).withColumn("text_key", F.xxhash64("text"))
    near = written(near_copies.marked_rows(docs).select(*key, "root"), "near")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), *key)).alias("first")
    first = near.groupBy("root").agg(least, F.count(F.lit(1)).alias("rows")).where("rows > 1").select("root", "first")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    keys = written(near.join(first, "root").groupBy(*key, stays.alias("stays")).count().where("not stays or count > 1"), "keys")
    forget(near)
    # Most rows are alone in their class: they pass without a shuffle.
    some, alone = split_by(docs, list(key), keys)
    other = keys.toDF("other_id", "other_text", "stays", "count")
    marked = some.join(other, F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("text_key") == F.col("other_text")), "left").where("stays is null or stays")
    # Of rows that share doc_id and text one stays.
    once = marked.where("stays").groupBy(*key).agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*")
    return alone.select(*COLUMNS).unionByName(marked.where("stays is null").select(*COLUMNS)).unionByName(once)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced and n_chars to match."""
    forest = secret_scan.train(secret_scan.labelled_findings(spark))
    clean = secret_scan.redact(docs.select(*COLUMNS).withColumn("_old", F.length("text")), forest)
    return clean.withColumn("n_chars", F.when(F.length("text") != F.col("_old"), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", without_toxic), ("simhash_near_dedup", without_near_copies), ("secret_scan", without_secrets), ("packing", packed)]

#: No SQL: the grammar, the forest and the tokenizer have no SQL form. The tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries():
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
