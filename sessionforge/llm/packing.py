"""Mixture-controlled packing: deficit round-robin over one queue per source.

Every round gives each queue its share of a window in tokens. What a queue could not send yet (a fraction of a token,
or less than its smallest burst) is its deficit and is carried into the next round. After r rounds a queue has sent
``floor(r * quantum)`` tokens, so the carried deficits have a closed form: each partition computes, from a few
totals, in which rounds its own tokens leave, without waiting for the partitions before it. The rounds follow one another
without a gap and are cut into windows, so no window holds padding; what is left at the end is cut into
windows whose lengths are powers of two.

Sources beyond ``max_queues`` share one queue. There each sends bursts of ``BURST`` tokens at even distances in proportion to its
tokens, the first at a distance given by a hash of its name, so at any point of the queue a source is about a burst or less off its share.

Steps: (1) token ids by partition, written once; (2) totals by (partition, source), a few rows; (3) the places of the bursts of
sources that share a queue, by a sort in buckets; (4) pieces, partition by partition. The ids are never shuffled while the totals fit a
broadcast join, but for documents of sources that share a queue.

Defined cases: a null text counts as empty and an empty text as its end id alone; rows with null or repeated doc_id are packed
like any other; a null source is a queue of its own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ensure_importable, slices, written
from .word_tokens import WordTokens

TOKENS = "doc_id long, queue string, part int, at long, n long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

#: Tokens that a queue with a small share, or a source in the shared queue, sends at once.
BURST = 64
#: Bursts of the shared queue that are put in order by one task at a time, about.
BUCKET = 50_000

_tokenizers: dict[str, WordTokens] = {}


def tokenizer(path: str) -> WordTokens:
    """One tokenizer for each file and worker."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokens(path)
    return _tokenizers[path]


def _tokens(batches, path: str, end_id: int):
    import pyarrow as pa
    from pyspark import TaskContext

    own, part, sent = tokenizer(path), TaskContext.get().partitionId(), {}
    last = np.array([end_id], own.dtype)
    for batch in batches:
        ids, queues = batch.column(0), batch.column(1).to_pylist()
        for a, b, texts in slices(batch.column(2)):
            at, n, data = [], [], []
            for q, x in zip(queues[a:b], own.encode(texts), strict=True):
                at.append(sent.get(q, 0))
                n.append(len(x) + 1)
                sent[q] = at[-1] + n[-1]
                data.append(np.concatenate((x, last)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, b - a), pa.array(queues[a:b], pa.string()), pa.array([part] * (b - a), pa.int32()), pa.array(at, pa.int64()), pa.array(n, pa.int64()), pa.array(data, pa.binary())],
                names=["doc_id", "queue", "part", "at", "n", "ids"],
            )


class Rounds:
    """How many tokens each queue has sent after r rounds, until all are empty."""

    def __init__(self, totals, weights, window: int, burst: int = BURST):
        self.totals = np.asarray(totals, np.int64)
        left, weights = self.totals.astype(float), np.asarray(weights, float)
        base, at, phases = np.zeros(len(left)), 0.0, []
        while (left > 0).any():
            active = left > 0
            share = np.where(active, weights, 0.0)
            if not share.sum():  # only queues without a target are left: they share in proportion to their tokens
                share = np.where(active, left, 0.0)
            rate = window * share / share.sum()
            with np.errstate(divide="ignore", invalid="ignore"):
                ends = np.where(rate > 0, left / rate, np.inf)
            step = ends.min()
            phases.append((at, base.copy(), rate))
            done = ends <= step * (1 + 1e-9)
            base, left, at = base + rate * step, left - rate * step, at + step
            base[done], left[done] = self.totals[done], 0.0
        self.starts = np.array([p[0] for p in phases] or [0.0])
        self.bases = np.array([p[1] for p in phases] or [base])
        self.rates = np.array([p[2] for p in phases] or [base])
        self.end = int(np.ceil(at - 1e-9)) if phases else 0
        #: A queue with a small share sends at least so many tokens at once.
        self.bursts = np.where(self.rates.max(axis=0) >= burst, 1, burst) if len(left) else np.zeros(0, int)

    def _sent(self, value, r, total, burst):
        whole = np.floor(np.minimum(value + 1e-9, total)).astype(np.int64)
        whole = np.where(whole >= total, total, whole // burst * burst)
        return np.where(r >= self.end, total, np.where(r <= 0, 0, whole))

    def sent(self, r, q):
        """Tokens of queue q[i] in the first r[i] rounds."""
        p = np.clip(np.searchsorted(self.starts, r, "right") - 1, 0, None)
        return self._sent(self.bases[p, q] + self.rates[p, q] * (r - self.starts[p]), r, self.totals[q], self.bursts[q])

    def all_sent(self, r):
        """One row for each round, one column for each queue."""
        p = np.clip(np.searchsorted(self.starts, r, "right") - 1, 0, None)
        return self._sent(self.bases[p] + self.rates[p] * (r - self.starts[p])[:, None], r[:, None], self.totals, self.bursts)

    def of(self, token, q):
        """The round in which token[i] of queue q[i] leaves."""
        low, high = np.zeros(len(token), np.int64), np.full(len(token), max(self.end - 1, 0), np.int64)
        while (low < high).any():
            mid = (low + high) // 2
            gone = self.sent(mid + 1, q) > token
            low, high = np.where(gone, low, mid + 1), np.where(gone, mid, high)
        return low


def placed(rounds: Rounds, q, first, n, window: int):
    """(document, start, length, sequence, offset) of all pieces of documents whose tokens are first..first+n of queue q."""
    parts, doc, at, end = [], np.arange(len(q)), first.copy(), first + n
    r = rounds.of(at, q)
    while len(doc):
        stop = np.minimum(rounds.sent(r + 1, q), end)
        parts.append((doc, r, at, stop))
        more = stop < end
        doc, q, at, end, r = doc[more], q[more], stop[more], end[more], r[more] + 1
        late = rounds.sent(r + 1, q) <= at
        if late.any():
            r[late] = rounds.of(at[late], q[late])
    return [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 4


def stream_position(rounds: Rounds, token, q, r, cells: int = 1 << 20):
    """Where token[i] of queue q[i], which leaves in round r[i], stands in the stream; by tables of rounds and queues with ``cells`` entries at most."""
    each, at = np.unique(r, return_inverse=True)
    rows = max(1, cells // len(rounds.totals))
    order = np.argsort(at, kind="stable")
    ends = np.searchsorted(at[order], np.arange(0, len(each) + rows, rows))
    out = np.zeros(len(r), np.int64)
    for some, k in zip(np.split(order, ends[1:-1]), range(0, len(each), rows), strict=False):
        sent = rounds.all_sent(each[k : k + rows])
        take = rounds.all_sent(each[k : k + rows] + 1) - sent
        row, own = at[some] - k, q[some]
        out[some] = sent.sum(axis=1)[row] + (np.cumsum(take, axis=1) - take)[row, own] + token[some] - sent[row, own]
    return out


def cut(position, length, total: int, window: int):
    """(index, shift, length, sequence, offset): stretches of the stream cut where windows end."""
    full = total // window * window
    tail = [1 << b for b in range(window.bit_length(), -1, -1) if (total - full) >> b & 1]
    starts = full + np.concatenate(([0], np.cumsum(tail))).astype(np.int64)
    index, shift, out = np.arange(len(position)), np.zeros(len(position), np.int64), []
    position, length = position.copy(), length.copy()
    while len(index):
        k = np.clip(np.searchsorted(starts, position, "right") - 1, 0, None)
        whole = position < full
        begin = np.where(whole, position // window * window, starts[k])
        stop = np.where(whole, begin + window, starts[np.minimum(k + 1, len(starts) - 1)])
        take = np.minimum(length, stop - position)
        out.append((index, shift, take, np.where(whole, position // window, full // window + k), position - begin))
        more = take < length
        index, shift, position, length = index[more], (shift + take)[more], (position + take)[more], (length - take)[more]
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 5


def _segments(q, first, n, bursts):
    """(row, start, place, length): rows of own queues as they are, rows of the shared queue cut into their bursts."""
    valid = bursts.is_valid().to_numpy(zero_copy_only=False)
    alone, many = np.flatnonzero(~valid), np.flatnonzero(valid)
    flat = bursts.drop_null().flatten()
    row = np.repeat(many, bursts.drop_null().value_lengths().to_numpy(zero_copy_only=False))
    begin, place = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    begin = begin.astype(np.int64) * BURST
    lo, hi = np.maximum(begin, first[row]), np.minimum(begin + BURST, first[row] + n[row])
    parts = (alone, row), (np.zeros(len(alone), np.int64), lo - first[row]), (first[alone], place + lo - begin), (n[alone], hi - lo)
    return [np.concatenate(x) for x in parts]


def _pieces(batches, rounds: Rounds, number: dict[str, int], window: int, size: int, with_ids: bool):
    import pyarrow as pa

    total, rest = int(rounds.totals.sum()), len(number)
    for batch in batches:
        for a in range(0, batch.num_rows, 2000):
            some = batch.slice(a, 2000)
            col = {name: some.column(i) for i, name in enumerate(some.schema.names)}
            q = np.array([number.get(x, rest) for x in col["queue"].to_pylist()], np.int64)
            row, begin, first, n = _segments(q, col["first"].to_numpy(), col["n"].to_numpy(), col["bursts"])
            q = q[row]
            doc, r, lo, hi = placed(rounds, q, first, n, window)
            position = stream_position(rounds, lo, q[doc], r)
            k, shift, length, sequence, offset = cut(position, hi - lo, total, window)
            doc, start = row[doc[k]], (lo - first[doc] + begin[doc])[k] + shift
            data = [memoryview(np.frombuffer(x.as_py(), f"<u{size}").astype("<u4").tobytes()) for x in col["ids"]]
            crc = [zlib.crc32(data[d][4 * s : 4 * (s + m)]) for d, s, m in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)]
            out = [col["doc_id"].take(pa.array(doc)), start, length, np.array(crc, np.int64), col["n"].to_numpy()[doc], sequence, offset]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                out.append(pa.array([bytes(data[d][4 * s : 4 * (s + m)]) for d, s, m in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, pa.int64()) for x in out], names=names)


def _bursts(sums: DataFrame) -> DataFrame:
    """(queue, burst, place): where each burst of the sources in ``sums`` (queue, n) begins in the queue they share."""
    each = sums.groupBy("queue").agg(F.sum("n").alias("total")).select("queue", "total", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(total - 1) div {BURST}"))).alias("burst"))
    length = F.least(F.lit(BURST), F.col("total") - F.col("burst") * BURST)
    phase = F.pmod(F.xxhash64("queue"), F.lit(1 << 20)) / F.lit(1 << 20)
    timed = each.select("queue", "burst", length.alias("length"), ((F.col("burst") * BURST + phase * length) / F.col("total")).alias("time"))
    buckets = max(1, each.count() // BUCKET)
    timed = written(timed.withColumn("bucket", F.floor(F.col("time") * buckets).cast("int")), "bursts")
    until = lambda w: F.coalesce(F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = timed.groupBy("bucket").agg(F.sum("length").alias("length")).select("bucket", until(Window.orderBy("bucket")).alias("before"))
    inside = until(Window.partitionBy("bucket").orderBy("time", "queue", "burst"))
    return timed.select("queue", "burst", "bucket", inside.alias("inside")).join(F.broadcast(before), "bucket").select("queue", "burst", (F.col("before") + F.col("inside")).alias("place"))


def pack(docs: DataFrame, tokenizer_path: str, *, window: int = 4096, end_id: int = 2, targets: dict[str, float] | None = None, max_queues: int = 1024, with_ids: bool = False) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text, source) in sequences of ``window`` tokens.

    ``targets`` gives sources their share of every window; by default each has its share of all tokens. Sources named in ``targets``
    have their own queues, then those with the most tokens up to ``max_queues``; all others share one queue, in which each keeps its natural share.
    """
    ensure_importable(docs.sparkSession)
    queue = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))
    ready = docs.select(F.col("doc_id").cast("long").alias("doc_id"), queue.alias("queue"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    tokens = written(ready.mapInArrow(partial(_tokens, path=tokenizer_path, end_id=end_id), TOKENS), "tokens", texts=True)
    sums = written(tokens.groupBy("part", "queue").agg(F.sum("n").alias("n")), "sums")
    named = [f"={x}" for x in targets or {}]
    top = sums.groupBy("queue").agg(F.sum("n").alias("n")).orderBy(F.desc(F.col("queue").isin(named)), F.desc("n"), "queue").limit(max(max_queues, len(named))).collect()
    number = {x.queue: i for i, x in enumerate(top)}
    total = sums.agg(F.sum("n")).first()[0] or 0
    totals = [x.n for x in top]
    totals.append(total - sum(totals))
    if targets is None:
        weights = totals
    else:
        weights = [targets.get(x.queue[1:], 0.0) if x.queue != "null" else 0.0 for x in top] + [0.0]
    rounds = Rounds(totals, weights, window)
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("part", "queue", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ready = tokens.join(before, ["part", "queue"]).select("doc_id", "queue", (F.col("at") + F.col("before")).alias("first"), "n", "ids")
    none = F.lit(None).cast("array<struct<burst:long,place:long>>").alias("bursts")
    if totals[-1]:
        own = F.coalesce(F.create_map(*[F.lit(y) for k in number for y in (k, True)])[F.col("queue")], F.lit(False)) if number else F.lit(False)
        number_of = F.explode(F.expr(f"sequence(first div {BURST}, (first + n - 1) div {BURST})"))
        cut_up = ready.where(~own).select("queue", "first", number_of.alias("burst")).join(_bursts(sums.where(~own)), ["queue", "burst"])
        cut_up = cut_up.groupBy("queue", "first").agg(F.collect_list(F.struct("burst", "place")).alias("bursts"))
        shared = ready.where(~own).join(cut_up, ["queue", "first"]).select("doc_id", "queue", "first", "n", "ids", "bursts")
        ready = ready.where(own).select("*", none).union(shared)
    else:
        ready = ready.select("*", none)
    size = tokenizer(tokenizer_path).dtype.itemsize
    schema = PIECES + (", ids binary" if with_ids else "")
    return ready.mapInArrow(partial(_pieces, rounds=rounds, number=number, window=window, size=size, with_ids=with_ids), schema)
