"""Digests of tables as trees of fan-out 16 over the hexadecimal digits of the keys' MD5.

A leaf has the number of its rows and two sums over the MD5s of their lines, so it needs no order, is counted in parts before the shuffle, and leaves of disjoint parts of a
table add up. Nodes above have the MD5 of their children in order. All of it comes from one pass over the rows; the tree has 16**depth leaves whatever the table's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionforge.sources.files import staged

DEPTH = 3


def _line(rows: DataFrame) -> Column:
    """The row's columns but loaded_at as one text; doubles and times as whole microseconds."""
    kinds = [(c, t) for c, t in rows.dtypes if c not in ("loaded_at", "_n")]
    exact = [F.round(F.col(c) * 1e6).cast("long") if t == "double" else F.unix_micros(c) if t == "timestamp" else F.col(c) for c, t in kinds]
    return F.concat_ws("|", *[F.coalesce(x.cast("string"), F.lit("~")) for x in exact])


def _path(rows: DataFrame, key, depth: int) -> Column:
    kinds = dict(rows.dtypes)
    return F.substring(F.md5(F.concat_ws("|", *[(F.unix_micros(c) if kinds[c] == "timestamp" else F.col(c)).cast("string") for c in key])), 1, depth)


def leaves(rows: DataFrame, key, depth: int = DEPTH, *by: str) -> DataFrame:
    """path, rows, a, b of each leaf that has rows (and of each value of the columns ``by``)."""
    line = F.md5(_line(rows.drop(*by)))
    part = lambda at: F.sum(F.conv(F.substring("line", at, 15), 16, 10).cast("decimal(38,0)"))
    return rows.select(*by, _path(rows, key, depth).alias("path"), line.alias("line")).groupBy(*by, "path").agg(F.count(F.lit(1)).alias("rows"), part(1).alias("a"), part(16).alias("b"))


def tree(sums: DataFrame, depth: int = DEPTH) -> DataFrame:
    """level, path, rows, digest of all nodes that have rows, and of the root, over leaves of one or more parts."""
    whole = sums.groupBy("path").agg(F.sum("rows").alias("rows"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    level = staged(whole.select("path", "rows", F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in ("rows", "a", "b")])).alias("digest")), "leaves")
    found = level.select(F.lit(depth).alias("level"), "*")
    told = F.md5(F.array_join(F.array_sort(F.collect_list(F.concat("path", F.lit("="), "digest"))), ","))  # at most 16 children
    for d in range(depth - 1, -1, -1):
        up = level.groupBy(F.substring("path", 1, d).alias("up")) if d else level.groupBy()
        level = up.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), told.alias("digest")).select(F.col("up").alias("path") if d else F.lit("").alias("path"), "rows", "digest")
        found = found.unionByName(level.select(F.lit(d).alias("level"), "*"))
    return found


def root(sums: DataFrame, depth: int = DEPTH) -> DataFrame:
    """One row (rows, digest)."""
    return tree(sums, depth).where("level = 0").select("rows", "digest")


def unlike(one: DataFrame, other: DataFrame, depth: int = DEPTH) -> list[str]:
    """The leaves in which two trees differ, found by going down from the root along unlike nodes only; at most 16**depth short texts."""
    paths = [""]
    for d in range(depth + 1):
        at = lambda t: t.where((F.col("level") == d) & (F.substring("path", 1, max(d - 1, 0)).isin(paths) if d > 1 else F.lit(True))).select("path", "digest")  # noqa: E731,B023
        both = at(one).join(at(other).withColumnRenamed("digest", "other"), "path", "full").where(~F.col("digest").eqNullSafe(F.col("other")))
        paths = sorted(r.path for r in both.select("path").collect())
        if not paths:
            return []
    return paths


def differing_keys(one: DataFrame, other: DataFrame, key, depth: int = DEPTH, trees: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """The key columns and ``side`` (left, right or both: same key, other values) of rows that two tables don't share. Only rows of unlike leaves are shuffled. Keys are unique and not null."""
    a, b = (staged(t, "tree") for t in trees or (tree(leaves(one, key, depth), depth), tree(leaves(other, key, depth), depth)))
    paths = unlike(a, b, depth)
    mine = lambda rows, name: rows.where(_path(rows, key, depth).isin(paths)).select(*key, F.md5(_line(rows)).alias(name))
    both = mine(one, "l").join(mine(other, "r"), list(key), "full").where(~F.col("l").eqNullSafe(F.col("r")))
    return both.select(*key, F.when(F.col("r").isNull(), "left").when(F.col("l").isNull(), "right").otherwise("both").alias("side"))
