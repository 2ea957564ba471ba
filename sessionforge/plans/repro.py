"""Published figures held against measured ones: counts must be equal, timings may move."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("counted", "timing")


def verdicts(figures: DataFrame) -> DataFrame:
    """name, ratio, verdict over (name, published, measured, kind); a published zero has ratio 1 or infinity."""
    if figures.isEmpty():
        raise ValueError("no figures")
    unknown = figures.where(~F.col("kind").isin(*KINDS)).limit(1).collect()
    if unknown:
        raise ValueError(f"unknown kind {unknown[0].kind!r}")
    same = F.col("published") == F.col("measured")
    ratio = F.when(F.col("published") == 0, F.when(same, 1.0).otherwise(float("inf"))).otherwise(F.try_divide("measured", "published"))
    verdict = F.when(same, "reproduced").when(F.col("kind") == "counted", "differs").otherwise("moved")
    return figures.select("name", "kind", ratio.alias("ratio"), verdict.alias("verdict"))


def report(figures: DataFrame) -> DataFrame:
    return verdicts(figures).agg(*[F.count_if(F.col("verdict") == v).alias(v) for v in ("reproduced", "differs", "moved")])
