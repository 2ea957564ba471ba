"""SimHash near-duplicates at a similarity of 0.8: the range join of ``simhash`` finds close copies, a prefix join all others, whole texts decide.

Two documents are linked if the Jaccard similarity of their sets of five-word shingles (as 64-bit hashes) is ``similarity`` or more; all
such pairs end in one class and no other pair is linked. Documents with equal sets are one node from the start.

A similarity of 0.8 lies at 10 +- 3 differing bits of 64. The grids of a range join that loses no pair at 14 bits have less than five segments
each and prune nothing, so the dealt method alone can't give right results here. Candidates therefore come from three steps:

1. ``simhash.links``: segment popcounts, grid range join under their Manhattan distance, complete for ``max_bits`` differing bits. It gives few
   pairs for large groups of close copies.
2. Prefixes: with the shingles of all sets in one order, two sets of the wanted similarity share one among the first
   ``n - ceil(similarity * n) + 1`` of each. Any order is right; frequent shingles (by a sample of documents) stand last, so that
   common passages bring few documents together. Each set is first compared with one other: the most central sets at its shingles (those that
   meet others at the largest part of their prefix) are hubs, and it takes the hub it meets most often. A text and thousands of edited
   copies of it so end in one class by as many comparisons.
3. All pairs that don't hang together by the first two steps, unless a bound rules them out: similar sets share a certain number of
   shingles of their prefixes, and differ in so few shingles that their sketches, the parities of the numbers of shingles in 512 buckets,
   differ in no more. After this no similar pair is missing.

On 10,000 documents (sf0.1) most of the 752 rows that go have sets equal to another's. Of the 48 links between different sets the second step gives 9,
the first at least the other 39, the third none.

Every candidate is verified on both whole texts: each text goes once to its partner with more candidates (the hub), whose text is sent to as many
places as its candidates fill, ``hub_rows`` each. Large groups of documents that share most of their shingles and still stay
below ``similarity`` are compared pair by pair: time grows with the square of such a group; memory doesn't, and a shingle that very many
have is dealt to pairs of blocks, so neither does a task.

Defined cases: as for ``simhash``; wordless texts are alike. Distinct shingles with one hash (2^-64 a pair) are taken as equal.
"""

from __future__ import annotations

from fractions import Fraction
from functools import partial
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ensure_importable, forget, slices, split_by, written
from .components import components
from .simhash import SEED, links

#: Frequent shingles are counted in one text of so many, and so many of them are known to all workers. They only set the order of shingles.
SAMPLE, FREQUENT = 16, 1 << 18
KEY = ("doc_id", "text_key")
#: The sketch of a set: 512 bits in eight numbers.
SKETCH = tuple(f"s{i}" for i in range(8))
MARKS = "doc_id long, text_key long, node long, fp long, size int, rare int, " + ", ".join(f"{c} long" for c in SKETCH) + ", prefix array<long>"


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= 1 << 16:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word, SEED)
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def shingle_sets(texts: list[bytes], words: int, known: _WordHashes) -> list[np.ndarray]:
    """The set of shingles of each text, as sorted 64-bit hashes."""
    factor = np.random.default_rng(SEED).integers(0, 1 << 63, words + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    parts = [t.lower().split() for t in texts]  # of bytes: only A-Z are lowered, only ASCII white space cuts
    size = list(map(len, parts))
    flat, out, at = np.fromiter(map(known.__getitem__, chain.from_iterable(parts)), np.uint64, sum(size)), [], 0
    for n in size:
        own, w = flat[at : at + n], min(n, words)
        sums = np.full(max(n - w + 1, 0) if n else 0, np.uint64(w)) * factor[words]
        for j in range(w if n else 0):
            sums += own[j : j + len(sums)] * factor[j]
        out.append(np.unique(_mixed(sums).view(np.int64)))
        at += n
    return out


def fingerprint(shingles: np.ndarray) -> int:
    """A bit is 1 if set in over half of the shingles' hashes."""
    sums = np.zeros(64, np.int64)
    for i in range(0, len(shingles), 1 << 14):
        sums += np.unpackbits(shingles[i : i + (1 << 14)].view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(sums * 2 > len(shingles)).view(np.int64)[0])


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Two sets differ in at least as many shingles as their sketches in bits."""
    return np.packbits(np.bincount(shingles.view(np.uint64) >> np.uint64(55), minlength=512) & 1).view(np.int64)


def prefixes(sets: list[np.ndarray], frequent: np.ndarray, rank: np.ndarray, share: Fraction):
    """(shingles, bounds, rare): the shingles of each set that a similar set has to share one of; from place ``rare`` on they are frequent. ``frequent`` is sorted."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    flat, doc = np.concatenate([*sets, np.zeros(0, np.int64)]), np.repeat(np.arange(len(sets)), size)
    late = np.zeros(len(flat), np.int64)
    if len(frequent):
        place = np.minimum(np.searchsorted(frequent, flat), len(frequent) - 1)
        late = np.where(frequent[place] == flat, rank[place], 0)
    order = np.lexsort((flat, late, doc))
    at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    taken = np.where(size > 0, size + -size * share.numerator // share.denominator + 1, 0)
    order = order[at < taken[doc]]
    return flat[order], np.cumsum(np.concatenate(([0], taken))), np.bincount(doc[order][late[order] == 0], minlength=len(sets))


def _marks(batches, words: int, frequent: np.ndarray, rank: np.ndarray, share: Fraction):
    """A prefix is given once a task: later rows of the same node have none."""
    import pyarrow as pa
    import xxhash

    known, seen, none = _WordHashes(), set(), np.zeros(0, np.int64)
    for batch in batches:
        for a, b, texts in slices(batch.column(2).cast(pa.binary()), 2_000_000):
            sets = shingle_sets(texts, words, known)
            node = [int(np.uint64(xxhash.xxh64_intdigest(s.tobytes(), SEED)).view(np.int64)) for s in sets]
            own = []
            for x, s in zip(node, sets, strict=True):
                own.append(none if x in seen else s)
                seen.add(x)
            flat, bounds, rare = prefixes(own, frequent, rank, share)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))
            columns = [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(node, pa.int64()), pa.array([fingerprint(s) for s in sets], pa.int64()), pa.array(list(map(len, sets)), pa.int32()), pa.array(rare, pa.int32())]
            sketches = np.stack([sketch(s) for s in sets])
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(sketches[:, i]) for i in range(8)), lists], names=["doc_id", "text_key", "node", "fp", "size", "rare", *SKETCH, "prefix"])


def _sampled(batches, words: int):
    import pyarrow as pa

    known = _WordHashes()
    for batch in batches:
        for _, _, texts in slices(batch.column(0).cast(pa.binary()), 2_000_000):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shingle_sets(texts, words, known)))], names=["shingle"])


def frequent_shingles(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, ranks): those in more than two of the sampled different texts, sorted, the most frequent with the highest rank."""
    some = docs.where(F.pmod(F.col("text_key"), F.lit(SAMPLE)) == 0).groupBy("text_key").agg(F.first("text").alias("text"))
    counts = some.select("text").mapInArrow(partial(_sampled, words=words), "shingle long").groupBy("shingle").count()
    shingles = counts.where("count > 2").orderBy(F.desc("count"), "shingle").limit(FREQUENT).toArrow()["shingle"].to_numpy()
    order = np.argsort(shingles)
    return shingles[order], np.arange(len(shingles), 0, -1)[order]


def _verified(batches, words: int, share: Fraction):
    """Rows come sorted by hub and salt, the hub's own text before its candidates."""
    import pyarrow as pa

    known, hub, own = _WordHashes(), None, np.zeros(0, np.int64)
    p, q = share.numerator, share.denominator
    for batch in batches:
        for a, b, texts in slices(batch.column(3).cast(pa.binary()), 2_000_000):
            left, right = [], []
            rows = zip(*(batch.column(i).slice(a, b - a).to_pylist() for i in range(3)), shingle_sets(texts, words, known), strict=True)
            for h, kind, node, s in rows:
                if kind == 0:
                    hub, own = h, s
                    continue
                if h != hub:
                    raise ValueError("a candidate came without its hub")
                common = len(np.intersect1d(own, s, assume_unique=True))
                if common * (p + q) >= (len(own) + len(s)) * p:
                    left.append(h)
                    right.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def similar(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, share: Fraction, hub_rows: int) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets are similar. ``nodes`` names a row of ``docs`` (doc_id, text_key, text) for each node."""
    pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct(), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    ends = written(ends.join(nodes.select("node", *KEY), "node").select("node", "n", *KEY), "ends")
    both = pairs.join(ends.select([F.col(c).alias(f"{c}_a") for c in ends.columns]), F.col("a") == F.col("node_a")).join(ends.select([F.col(c).alias(f"{c}_b") for c in ends.columns]), F.col("b") == F.col("node_b"))
    a_is_hub = F.struct("n_a", "a") > F.struct("n_b", "b")
    side = lambda c, is_hub: F.when(a_is_hub == is_hub, F.col(f"{c}_a")).otherwise(F.col(f"{c}_b"))
    salt = F.pmod(F.xxhash64(side("node", False)), F.ceil(side("n", True) / F.lit(hub_rows))).cast("int")
    row = lambda kind, is_hub: both.select(side("node", True).alias("hub"), salt.alias("salt"), F.lit(kind).alias("kind"), side("node", is_hub).alias("node"), *[side(c, is_hub).alias(f"_{c}") for c in KEY])
    wanted = written(row(0, True).distinct().union(row(1, False)), "wanted")
    some, _ = split_by(docs, list(KEY), wanted.select(F.col("_doc_id").alias("doc_id"), F.col("_text_key").alias("text_key")))
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_key") == F.col("_text_key"))
    sent = some.join(wanted, same).select("hub", "salt", "kind", "node", "text").repartition("hub", "salt").sortWithinPartitions("hub", "salt", "kind")
    found = sent.select("hub", "kind", "node", "text").mapInArrow(partial(_verified, words=words, share=share), "a long, b long")
    found = written(found.distinct(), "similar", texts=True)
    forget(pairs, ends, wanted)
    return found


def shared_shingles(marked: DataFrame) -> DataFrame:
    """(shingle, node, size): the prefixes' shingles that different nodes have."""
    cells = marked.where("prefix is not null").select("node", "size", "rare", F.posexplode("prefix").alias("at", "shingle"))
    least, most = (f("node").over(Window.partitionBy("shingle")) for f in (F.min, F.max))
    rare = cells.where("at < rare").select("shingle", "node", "size", least.alias("least"), most.alias("most"))
    # Frequent shingles, of which there are FREQUENT at most, may be in a third of all rows: these are counted before a shuffle and not moved.
    often = cells.where("at >= rare").select("shingle", "node", "size")
    ends = often.groupBy("shingle").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    often = often.join(F.broadcast(ends), "shingle").select(rare.columns)
    return rare.union(often).where("least != most").select("shingle", "node", "size").distinct()


def first_partners(shared: DataFrame, share: Fraction) -> DataFrame:
    """(a, b): each node with the hub it meets most often, if that is a quarter of what a similar one needs or more."""
    central = shared.groupBy("node", "size").agg((F.count(F.lit(1)) / F.col("size")).alias("central")).select("node", "central")
    placed = shared.join(central, "node")
    best = placed.groupBy("shingle").agg(F.max(F.struct("central", "node", "size")).alias("hub")).select("shingle", F.col("hub.node").alias("hub"), F.col("hub.size").alias("hub_size"))
    met = placed.join(best, "shingle").where("node != hub").groupBy("node", "hub", "size", "hub_size").agg(F.count(F.lit(1)).alias("met"))
    most = met.groupBy("node").agg(F.max("met").alias("met"), *[F.max_by(c, "met").alias(c) for c in ("hub", "size", "hub_size")])
    return most.where(could_be(4 * F.col("met"), F.col("size"), F.col("hub_size"), share)).select(F.col("node").alias("a"), F.col("hub").alias("b"))


def could_be(met: Column, left: Column, right: Column, share: Fraction) -> Column:
    """Whether sets of these sizes whose prefixes share ``met`` shingles can be similar.

    Of the shingles they share, those not in both prefixes come after the prefix that ends first.
    """
    p, q = share.numerator, share.denominator
    after = lambda size: F.floor((size.cast("long") * F.lit(p) + F.lit(q - 1)) / F.lit(q)) - 1  # noqa: E731  what a prefix leaves out
    common = F.least(met + F.greatest(after(left), after(right)), left, right)
    return common * F.lit(p + q) >= (left + right).cast("long") * F.lit(p)


def block_pairs(rows: DataFrame) -> DataFrame:
    """``rows`` (node, blocks, ...) once for each pair of blocks that theirs is in, its own with itself included, as a number ``pair``."""
    own, other = block_of("node"), F.col("other")
    each = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return each.withColumn("pair", F.least(own, other) * F.col("blocks").cast("long") + F.greatest(own, other)).drop("other")


def block_of(node: str) -> Column:
    return F.pmod(F.xxhash64(node), F.col("blocks"))


def meeting(shared: DataFrame, nodes: DataFrame, roots: DataFrame, share: Fraction, cell_rows: int) -> DataFrame:
    """The pairs (a, b) of nodes that hang on different roots and could be similar; no similar pair is missing.

    A shingle that more than ``cell_rows`` nodes have is dealt to pairs of blocks, so no task compares more than some ``cell_rows`` squared for it.
    """
    hung = shared.join(roots, "node", "left").select("shingle", "node", "size", F.coalesce("root", "node").alias("root"))
    ends = hung.groupBy("shingle").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("n"))
    mixed = ends.where("x != y").select("shingle", F.ceil(F.col("n") / cell_rows).cast("int").alias("blocks"))
    x = block_pairs(hung.join(mixed, "shingle").join(nodes.select("node", *SKETCH), "node"))
    y = x.select([F.col(c).alias(c if c in ("shingle", "pair") else f"{c}_2") for c in x.columns])
    p, q = share.numerator, share.denominator
    differ = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_2"))) for c in SKETCH), F.lit(0))
    alike = differ * F.lit(p + q) <= (F.col("size") + F.col("size_2")).cast("long") * F.lit(q - p)
    # Two of one block meet in that block's pair with itself only.
    once = (block_of("node") != block_of("node_2")) | (F.col("pair") == block_of("node") * (F.col("blocks") + 1))
    both = x.join(y, ["shingle", "pair"]).where((F.col("node") < F.col("node_2")) & once & (F.col("root") != F.col("root_2")) & could_be(F.col("size"), F.col("size"), F.col("size_2"), share) & alike)
    pairs = both.groupBy(F.col("node").alias("a"), F.col("node_2").alias("b"), "size", "size_2").agg(F.count(F.lit(1)).alias("met"))
    return pairs.where(could_be(F.col("met"), F.col("size"), F.col("size_2"), share)).select("a", "b")


def marked_rows(docs: DataFrame, *, words: int = 5, similarity: float = 0.8, max_bits: int = 3, cell_rows: int = 4096, hub_rows: int = 1024) -> DataFrame:
    """doc_id, text_key (a hash of the text), node, root (the same for all nodes of a class) and component_id of every row."""
    ensure_importable(docs.sparkSession)
    share = Fraction(str(similarity))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.coalesce("text", F.lit("")).alias("text"))
    frequent, rank = frequent_shingles(docs, words)
    marked = written(docs.mapInArrow(partial(_marks, words=words, frequent=frequent, rank=rank, share=share), MARKS), "marked", texts=True)
    nodes = written(marked.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.min("text_key").alias("text_key"), F.min_by("doc_id", "text_key").alias("doc_id"), F.min("fp").alias("fp"), *[F.min(c).alias(c) for c in SKETCH], F.count(F.lit(1)).alias("n")), "nodes")
    shared = written(shared_shingles(marked), "shared")
    rows = written(marked.select(*KEY, "node"), "rows")
    prints = written(nodes.groupBy("fp").agg(F.min("node").alias("first")), "prints")
    forget(marked)
    alike = nodes.join(prints, "fp").select("node", "first")
    close = links(prints, max_bits, cell_rows).join(prints.toDF("a", "x"), "a").join(prints.toDF("b", "y"), "b").select("x", "y")
    near = similar(close.union(alike).union(first_partners(shared, share)).toDF("a", "b"), nodes, docs, words, share, hub_rows)
    first = components(near)
    rest = similar(meeting(shared, nodes, first, share, cell_rows), nodes, docs, words, share, hub_rows)
    roots = components(first.toDF("a", "b").union(rest))
    hung = nodes.join(roots, "node", "left").select("node", "least_id", "n", F.coalesce("root", "node").alias("root"))
    class_of = hung.groupBy("root").agg(F.min("least_id").alias("component_id"), F.sum("n").alias("rows"))
    named = written(hung.join(class_of.where("rows > 1"), "root").select("node", "root", "component_id"), "classes")
    forget(nodes, shared, prints, near, rest)
    return rows.join(named, "node", "left").select(*KEY, "node", F.coalesce("root", "node").alias("root"), F.coalesce("component_id", "doc_id").alias("component_id"))


def near_copies(docs: DataFrame, **how) -> DataFrame:
    """doc_id and component_id (the smallest doc_id reachable over links) of every row; ``how`` as for ``marked_rows``."""
    return marked_rows(docs, **how).select("doc_id", "component_id")
