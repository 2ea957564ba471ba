"""SimHash near-duplicates: a popcount embedding of fingerprints, a grid join under its Manhattan distance, exact verification.

A fingerprint's 64 bits are 32 segments of two; the bit counts of the segments (0 to 2 each) are its embedding. Two
fingerprints differ in at least as many bits as their embeddings differ in Manhattan distance. With ``groups`` groups of
segments, fingerprints within ``max_bits`` lie within ``max_bits // groups`` <= 1 of each other in some group, so each
fingerprint stands in its grid cell of every group and looks into the cells one step above; every link meets in one
of them. Pairs that meet are verified by their differing bits.

Equal fingerprints are one node from the start. A cell is read in sorted order, residents before visitors, and gives no more than a spanning
forest of its links, never all pairs. Cells in which more than ``cell_rows`` residents and visitors meet are cut into blocks, and each pair
of blocks is a group of rows of its own, so none reads or holds more than about two blocks.

Defined cases: words are runs of anything but ASCII white space, after lower-casing A-Z; with fewer words than a shingle
the whole sequence is the one shingle; a null or wordless text has fingerprint zero and links like any other. Rows
with null doc_id count but name no component (its id is the smallest doc_id that isn't null). Repeated rows
are kept. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ensure_importable, written
from .components import components

SEED = 42
_WEIGHTS = 1 << np.arange(63, -1, -1, dtype=np.uint64)


def shingles(text: bytes, words: int) -> list[bytes]:
    parts = text.lower().split()  # of bytes: only A-Z are lowered, only ASCII white space cuts
    if len(parts) < words:
        return [b" ".join(parts)] if parts else []
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return [line[a:b] for a, b in zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)]


def fingerprint(text: bytes, words: int = 3) -> int:
    """The fingerprint as a signed 64-bit number."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    h = np.array([digest(s, SEED) for s in shingles(text, words)], ">u8")
    sums = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        sums += np.unpackbits(h[i : i + (1 << 16)].view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(_WEIGHTS[sums * 2 > len(h)].sum().astype(np.uint64).view(np.int64)) if len(h) else 0


def _fingerprints(batches, words: int):
    import pyarrow as pa

    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(t.as_py(), words) for t in texts], pa.int64())], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp) of every row."""
    ensure_importable(docs.sparkSession)
    ready = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return ready.mapInArrow(partial(_fingerprints, words=words), "doc_id long, fp long")


def segment_counts(fp: np.ndarray) -> np.ndarray:
    """The bit counts of the 32 two-bit segments, each in its own two bits of the result."""
    low = np.uint64(0x5555555555555555)
    return (fp & low) + (fp >> np.uint64(1) & low)


def _cells(batches, groups: int):
    import pyarrow as pa

    edges = np.linspace(0, 32, groups + 1).astype(int)
    for batch in batches:
        fp = batch.column(0).to_numpy()
        counts = segment_counts(fp.view(np.uint64))
        for g in range(groups):
            shift, bits = np.uint64(2 * edges[g]), np.uint64((1 << 2 * int(edges[g + 1] - edges[g])) - 1)
            home = counts >> shift & bits
            keys, fps, visits = [home], [fp], [np.zeros(len(fp), bool)]
            for s in range(edges[g + 1] - edges[g]):
                up = home >> np.uint64(2 * s) & np.uint64(3)
                can = up < 2
                keys.append(home[can] + np.uint64(1 << 2 * s))
                fps.append(fp[can])
                visits.append(np.ones(can.sum(), bool))
            n = sum(map(len, keys))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, g, np.int32)), pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(fps)), pa.array(np.concatenate(visits))], names=["grp", "cell", "fp", "visits"])


def _forest(a: np.ndarray, b: np.ndarray):
    """A spanning forest of the links a-b between small numbers, as (kept a, kept b)."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    keep = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = root(x), root(y)
        if x != y:
            up[max(x, y)] = min(x, y)
            keep.append(i)
    return a[keep], b[keep]


def _links(run: np.ndarray, fp: np.ndarray, visits: np.ndarray, max_bits: int, step: int = 1 << 20):
    """Links within runs of equal ``run``: residents with residents and residents with visitors, a forest for each slice of pairs."""
    first = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
    size = np.diff(np.concatenate((first, [len(run)])))
    residents = np.add.reduceat(~visits, first) if len(first) else np.zeros(0, int)
    # Row i of a run meets the residents before it (for a visitor: all of them).
    at = np.arange(len(run)) - np.repeat(first, size)
    meets = np.minimum(at, np.repeat(residents, size))
    begin = np.repeat(first, size)
    total, out_a, out_b = np.cumsum(meets), [], []
    i = 0
    while i < len(run):
        j = max(int(np.searchsorted(total, (total[i - 1] if i else 0) + step, "right")), i + 1)
        m = meets[i:j]
        left = np.repeat(np.arange(i, j), m)
        right = np.repeat(begin[i:j] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        near = np.bitwise_count(fp[left].view(np.uint64) ^ fp[right].view(np.uint64)) <= max_bits
        if near.any():
            a, b = _forest(left[near], right[near])
            out_a.append(fp[a])
            out_b.append(fp[b])
        i = j
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (fp[:0], fp[:0])


def _verified(batches, max_bits: int):
    """Rows come sorted by cell, residents first; a cell may span batches, so its residents are carried along."""
    import pyarrow as pa

    carry = None
    for batch in batches:
        now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
        if carry is not None:
            now = [np.concatenate(x) for x in zip(carry, now, strict=True)]
        grp, cell, block, fp, visits = now
        new = np.concatenate(([True], (cell[1:] != cell[:-1]) | (block[1:] != block[:-1]) | (grp[1:] != grp[:-1])))
        a, b = _links(np.cumsum(new), fp, visits, max_bits)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        tail = np.arange(len(new) - 1 - np.argmax(new[::-1]), len(new)) if len(new) else np.zeros(0, int)
        tail = tail[~visits[tail]]
        carry = [x[tail] for x in now]


def dealt(rows: DataFrame, full: DataFrame, key: str) -> DataFrame:
    """``rows`` (grp, cell, ``key``, ...) with a column block: rows of the cells in ``full`` (grp, cell, blocks) once for each pair of blocks that theirs is in."""
    own, blocks = F.pmod(F.xxhash64(key), F.col("blocks")).cast("int"), F.col("blocks")
    others = F.filter(F.sequence(F.lit(0), blocks - 1), lambda k: k != own)
    pairs = F.transform(others, lambda k: F.least(own, k).cast("long") * blocks + F.greatest(own, k))
    block = F.explode(F.when(blocks.isNull(), F.array(F.lit(0).cast("long"))).otherwise(pairs))
    return rows.join(full, ["grp", "cell"], "left").select(*rows.columns, block.alias("block"))


def links(nodes: DataFrame, max_bits: int = 3, cell_rows: int = 4096) -> DataFrame:
    """(a, b): links between different fingerprints ``nodes`` (fp) that connect all that lie within ``max_bits``."""
    groups = max(1, (max_bits + 2) // 2)
    cells = nodes.select("fp").mapInArrow(partial(_cells, groups=groups), "grp int, cell long, fp long, visits boolean")
    homes = nodes.select("fp").mapInArrow(partial(_homes, groups=groups), "grp int, cell long").groupBy("grp", "cell").count()
    # A cell has visitors from up to ``steps`` cells below it; those of cells too small to matter are not counted.
    steps = -(-32 // groups)
    reached = homes.where(F.col("count") > cell_rows // (steps + 1)).mapInArrow(partial(_reached, groups=groups), "grp int, cell long, n long")
    full = reached.groupBy("grp", "cell").agg(F.sum("n").alias("n")).where(F.col("n") > cell_rows)
    full = written(full.select("grp", "cell", (F.ceil(F.col("n") / cell_rows) + 1).cast("int").alias("blocks")), "full")
    ready = dealt(cells, full, "fp").repartition("grp", "cell", "block").sortWithinPartitions("grp", "cell", "block", "visits")
    return ready.select("grp", "cell", "block", "fp", "visits").mapInArrow(partial(_verified, max_bits=max_bits), "a long, b long")


def _homes(batches, groups: int):
    import pyarrow.compute as pc

    for batch in _cells(batches, groups):
        yield batch.filter(pc.invert(batch.column(3))).select(["grp", "cell"])


def _reached(batches, groups: int):
    """The cells that the residents of cells (grp, cell, count) stand in or visit, with their number."""
    import pyarrow as pa

    edges = np.linspace(0, 32, groups + 1).astype(int)
    for batch in batches:
        grp, cell, n = (batch.column(i).to_numpy() for i in range(3))
        parts = [(grp, cell, n)]
        for s in range(int(np.diff(edges).max())):
            can = (s < np.diff(edges)[grp]) & (cell.view(np.uint64) >> np.uint64(2 * s) & np.uint64(3) < 2)
            parts.append((grp[can], (cell.view(np.uint64)[can] + np.uint64(1 << 2 * s)).view(np.int64), n[can]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], names=["grp", "cell", "n"])


def near_duplicates(docs: DataFrame, *, words: int = 3, max_bits: int = 3, cell_rows: int = 4096) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable over links of up to ``max_bits``) of every row."""
    marked = written(fingerprints(docs, words), "fingerprints", texts=True)
    nodes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "nodes")
    roots = components(links(nodes, max_bits, cell_rows))
    hung = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked"))
    class_of = hung.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("rows"))
    named = written(hung.join(class_of.where("rows > 1"), "root").select("fp", "component_id"), "classes")
    # Most rows are alone in their class and need no partner here.
    return marked.join(named, "fp", "left").select("doc_id", "fp", F.coalesce("component_id", "doc_id").alias("component_id"))


def as_hex(fp) -> F.col:
    """16 lower-case hexadecimal digits of a signed 64-bit number."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
