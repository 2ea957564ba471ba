"""Whitening of embeddings by a tiled covariance.

Pairs of dimensions are dealt to tiles (``TILE`` wide, or a quarter of a width beyond four of them, since every row goes to every tile); the rows of the fit list are dealt to blocks by a hash. A task gets the two column
blocks of one tile and one row block, centres and multiplies them; products are summed per tile by an aggregate, and only the assembled matrix,
whose size follows the width of the vectors and not their number, goes to the driver for its eigenvectors. The covariance of the
whitened rows is measured in the same way afterwards, which gives ``identity_error``.

Entries become whole numbers floor(256 * c), and the fit list is each distinct vector of them once, so that repeated rows don't weigh.

Defined cases: vectors that are null or hold null or non-finite entries are dropped; other rows stay, with null and repeated vec_ids as they are;
shorter vectors are filled with zeros; an empty table, or one whose vectors are all empty, gives no rows; fewer dimensions than
``components`` give as many. Along a component without variance (its eigenvalue is below 1e-12 of the largest, or all rows are equal)
``whitened`` is null and it takes no part in ``identity_error``, which is null where no component has any; ``explained`` stays its share of the variance, or is null where no dimension varies. A
``deviation`` beyond 64 bits is null. Entries beyond 2**53 / 256 are cut there, as doubles don't tell them apart. Other columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import matrix
from .common import ensure_importable, forget, written

SCALE, TILE, ROW_BLOCK = 256, 32, 4096
FLAT = 1e-12
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole(rows: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that take part; all x have the width of the widest."""
    c = F.col("embedding").cast("array<double>")
    ok = F.forall(c, lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) != float("inf")))
    most = float(1 << 53)
    cut = lambda y: F.greatest(F.least(F.floor(y * SCALE), F.lit(1 << 53)), F.lit(-(1 << 53)))
    near = lambda y: F.greatest(F.least(y, F.lit(most)), F.lit(-most))  # noqa: E731  so that the product stays a long
    return rows.where(F.col("embedding").isNotNull() & ok).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(c, lambda y: cut(near(y))).alias("x"))


def _tiles(width: int, tile: int) -> list[tuple[int, int]]:
    blocks = -(-width // tile)
    return [(i, j) for i in range(blocks) for j in range(i, blocks)]


def _product(key, group, centre: np.ndarray, tile: int):
    """The product of two centred column blocks over one row block, one row for each pair of dimensions."""
    import pyarrow as pa

    t, i, j = (k.as_py() for k in key[1:])
    a = matrix(group["a"]) - centre[i * tile : (i + 1) * tile]
    b = a if i == j else matrix(group["b"]) - centre[j * tile : (j + 1) * tile]
    product = a.T @ b
    k = np.arange(product.size, dtype=np.int32)
    return pa.table({"i": i * tile + k // product.shape[1], "j": j * tile + k % product.shape[1], "v": product.ravel()})


def covariance(rows: DataFrame, column: str, n: int, centre: np.ndarray, *, tile: int = TILE, row_block: int = ROW_BLOCK) -> np.ndarray:
    """The covariance (divisor n) of an array column about ``centre``; all arrays have its width."""
    width = len(centre)
    pairs = _tiles(width, tile)
    blocks = max(1, -(-n // row_block))
    v = F.col(column)
    tiles = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(i).alias("i"), F.lit(j).alias("j")) for t, (i, j) in enumerate(pairs)])
    part = lambda at: F.slice(v, at * tile + 1, F.lit(tile))
    dealt = rows.select(v, F.pmod(F.xxhash64(v), F.lit(blocks)).alias("block"), F.explode(tiles).alias("at")).select(
        "block", F.col("at.t").alias("t"), F.col("at.i").alias("bi"), F.col("at.j").alias("bj"), part(F.col("at.i")).alias("a"), F.when(F.col("at.i") != F.col("at.j"), part(F.col("at.j"))).alias("b")
    )

    def multiply(key, group):
        return _product(key, group, centre, tile)

    found = dealt.groupBy("block", "t", "bi", "bj").applyInArrow(multiply, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((width, width))
    for r in found.collect():  # width squared numbers
        out[r.i, r.j] = out[r.j, r.i] = r.v / n
    return out


def _summed(fit: DataFrame, width: int) -> np.ndarray:
    """The exact sums of each dimension, as Python integers."""
    got = fit.select(F.posexplode("x").alias("d", "e")).groupBy("d").agg(F.sum(F.col("e").cast("decimal(38,0)")).alias("s")).collect()
    sums = [0] * width
    for r in got:
        sums[r.d] = int(r.s)
    return np.array(sums, dtype=object)


def _whitened(x: np.ndarray, centre: np.ndarray, axes: np.ndarray) -> np.ndarray:
    return (x - centre) @ axes


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """sum over dimensions of (n*x-S)^2: in 64 bits where it surely fits, else in Python integers."""
    top = max((n * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0))), 1)
    if top * top * max(len(sums), 1) < 1 << 63:
        return ((n * x - sums.astype(np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(r, sums.tolist(), strict=True)) for r in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def _project(batches, centre: np.ndarray, axes: np.ndarray):
    import pyarrow as pa

    for batch in batches:
        w = _whitened(matrix(batch.column(0)), centre, axes)
        yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), w.shape[1]).cast(pa.list_(pa.float64()))], names=["w"])


def _rows(batches, n: int, sums: np.ndarray, axes: np.ndarray, alive: list[bool], explained: list[float | None], error: float | None):
    import pyarrow as pa

    k, centre = len(alive), (sums / n).astype(float)
    for batch in batches:
        x = matrix(batch.column(1))
        w = _whitened(x, centre, axes)
        m = len(x)
        each = lambda values: pa.array(np.repeat(np.asarray(values, dtype=object), k).tolist(), pa.int64())
        dead = np.tile([not a for a in alive], m)
        cols = [each(batch.column(0).to_pylist()), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, n)), each(_deviation(x, n, sums)), pa.array(w.ravel(), pa.float64(), mask=dead), pa.array(explained * m, pa.float64()), pa.array([error] * (m * k), pa.float64())]
        yield pa.RecordBatch.from_arrays(cols, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def whiten(rows: DataFrame, *, components: int = 4, tile: int | None = None, row_block: int = ROW_BLOCK) -> DataFrame:
    """One row for each vector of ``rows`` (vec_id, embedding) and component, the strongest first."""
    spark = rows.sparkSession
    ensure_importable(spark)
    every = written(whole(rows), "whole")
    width = every.agg(F.max(F.size("x"))).first()[0] or 0
    if not width:
        forget(every)
        return spark.createDataFrame([], SCHEMA)
    padded: Column = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
    every = every.select("vec_id", padded.alias("x"))
    fit = written(every.select("x").distinct(), "fit")
    n = fit.count()
    sums = _summed(fit, width)
    centre = (sums / n).astype(float)
    tile = tile or max(TILE, -(-width // 4))
    v = covariance(fit, "x", n, centre, tile=tile, row_block=row_block)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    alive = [bool(e > FLAT * max(values[0], 0) and e > 0) for e in values]
    axes = np.where(alive, vectors / np.sqrt(np.where(alive, values, 1.0)), 0.0)
    total = float(np.trace(v))
    explained = [float(max(e, 0) / total) if total > 0 else None for e in values]
    error = None
    if any(alive):
        kept = axes[:, alive]
        spread = fit.select("x").mapInArrow(partial(_project, centre=centre, axes=kept), "w array<double>")
        again = written(spread, "spread")
        means = again.select(F.posexplode("w").alias("d", "e")).groupBy("d").agg(F.avg("e").alias("m")).orderBy("d").collect()
        held = covariance(again, "w", n, np.array([r.m for r in means]), tile=tile, row_block=row_block)
        error = float(np.abs(held - np.eye(kept.shape[1])).max())
        forget(again)
    forget(fit)
    return every.mapInArrow(partial(_rows, n=n, sums=sums, axes=axes, alive=alive, explained=explained, error=error), SCHEMA)
