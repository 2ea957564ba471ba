"""Spelling variants: each word's near words (one code point inserted, deleted or replaced), its form and the root of its forms.

Near words are found by two-dimensional range reporting. The words of one length stand in forward order and in the order of their reversed spelling; a
wavelet tree holds the one as a sequence of places in the other. For each place where a word may be edited, the words that share what is
before it are an interval of the first order, those that share what is after it an interval of the second, and the tree reports the
points in both: words of the same length differ there by a replaced code point, words that are longer by one have one inserted.

A word goes only where it can meet near words. Its edit places are cut into ``SEGMENTS`` parts; near words that differ within a part agree before and
after it, so both carry the key (length, part, what is before, what is after). Keys are dealt by hash to buckets of about ``BUCKET`` words, each an index
of its own. A key with more than ``BUCKET`` words is dealt to pairs of blocks (the words that ask, the words that are asked), each a bucket of
its own, so no task grows with a key; nothing is capped. Each edit place of a word is asked in one bucket, or once in each block of a large key, so that a pair comes once.

Defined cases: a null text has no words; a null doc_id counts as an empty one in the hash; an empty table gives no rows; ties for the form go to the
smallest word in code-point order; repeated rows count each time; other columns are ignored; words may be of any length.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ensure_importable, forget, written

SEGMENTS, BUCKET = 4, 20_000
# Letters of a run, the shortest word, fewest occurrences, one run in so many loses a code point, how many times as frequent a form must be.
RUN, SHORTEST, FEWEST, SLIP, TIMES = "[A-Za-zÀ-ÿ]{7,}", 7, 2, 31, 10
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(docs: DataFrame) -> DataFrame:
    """(w): every maximal run of at least seven letters, lower-cased (A-Z only) and with a code point less where the hash says so. Shorter runs can't become words."""
    run = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all("text", F.lit(f"({RUN})"), F.lit(1))).alias("run"))
    low = run.select("id", F.translate("run", _UPPER, _LOWER).alias("run")).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.expr("substring(run, 1, cast(h % length(run) as int))"), F.substring("run", at + 2, F.length("run")))
    return low.select(F.when(F.col("h") % SLIP == 0, less).otherwise(F.col("run")).alias("w"))


def words(docs: DataFrame, shortest: int = SHORTEST, fewest: int = FEWEST) -> DataFrame:
    """(w, n)."""
    return runs(docs).where(F.length("w") >= shortest).groupBy("w").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= fewest)


class Wavelet:
    """A permutation as a wavelet tree, one row of ranks a bit, the highest first."""

    def __init__(self, values: np.ndarray):
        self.bits, self.zeros, self.ranks = max(1, int(len(values) - 1).bit_length()), [], []
        for b in range(self.bits - 1, -1, -1):
            one = (values >> b) & 1 == 1
            self.ranks.append(np.concatenate(([0], np.cumsum(~one))))
            self.zeros.append(int(self.ranks[-1][-1]))
            values = np.concatenate((values[~one], values[one]))

    def report(self, low, high, least, most) -> tuple[np.ndarray, np.ndarray]:
        """(query, value): the values in [least, most) at places [low, high), for many queries at once."""
        query = np.flatnonzero((low < high) & (least < most))
        low, high, value = low[query], high[query], np.zeros(len(query), np.int64)
        for b, (zeros, rank) in zip(range(self.bits - 1, -1, -1), zip(self.zeros, self.ranks, strict=True), strict=True):
            l0, h0 = rank[low], rank[high]
            query = np.concatenate((query, query))
            value = np.concatenate((value, value + (1 << b)))
            low, high = np.concatenate((l0, zeros + low - l0)), np.concatenate((h0, zeros + high - h0))
            some = (low < high) & (value < most[query]) & (value + (1 << b) > least[query])
            query, low, high, value = query[some], low[some], high[some], value[some]
        return query, value


class Order:
    """Words in order with the length of the prefix that each shares with the one before it."""

    def __init__(self, spelled: list[str], width: int):
        self.at = np.array(sorted(range(len(spelled)), key=spelled.__getitem__), np.int64)
        self.rank = np.empty(len(spelled), np.int64)
        self.rank[self.at] = np.arange(len(spelled))
        letters = np.array([spelled[i] for i in self.at], f"U{width}").view(np.uint32).reshape(len(spelled), width)
        differ = letters[1:] != letters[:-1]
        self.shared = np.concatenate(([-1], np.where(differ.any(axis=1), differ.argmax(axis=1), width)))

    def interval(self, words: np.ndarray, prefix: int) -> tuple[np.ndarray, np.ndarray]:
        """The places of all words that begin with the first ``prefix`` code points of each of ``words``."""
        edges = np.append(np.flatnonzero(self.shared < prefix), len(self.at))
        k = np.searchsorted(edges, self.rank[words], "right")
        return edges[k - 1], edges[k]


class Grid:
    """Words of some length and those longer by one, in both orders; each of the two lengths has its tree."""

    def __init__(self, spelled: list[str], length: int):
        self.spelled, self.length = spelled, length
        self.forward, self.reverse = Order(spelled, length + 1), Order([w[::-1] for w in spelled], length + 1)
        longer = np.array([len(w) > length for w in spelled])
        self.trees = [self._tree(np.flatnonzero(longer == more)) for more in (False, True)]

    def _tree(self, own: np.ndarray):
        """Points of the words ``own``, and for each place of the orders of all how many of them stand before it."""
        before = []
        for order in (self.forward, self.reverse):
            held = np.zeros(len(self.spelled) + 1, np.int64)
            held[order.rank[own] + 1] = 1
            before.append(np.cumsum(held))
        rank = [order.rank[own] for order in (self.forward, self.reverse)]
        place = [before[0][rank[0]], before[1][rank[1]]]
        values = np.empty(len(own), np.int64)
        values[place[0]] = place[1]
        by_value = np.empty(len(own), np.int64)
        by_value[place[1]] = own
        return before, Wavelet(values) if len(own) else None, by_value

    def near(self, asks: np.ndarray, place: int) -> tuple[np.ndarray, np.ndarray]:
        """(word, near word) for words of the grid's length and an edit at ``place``: all that differ there by a replaced or an inserted code point."""
        found = []
        low, high = self.forward.interval(asks, place)
        for more, (before, tree, by_value) in enumerate(self.trees):
            if tree is None or not more and place == self.length:
                continue
            least, most = self.reverse.interval(asks, self.length - place - (not more))
            query, value = tree.report(before[0][low], before[0][high], before[1][least], before[1][most])
            a, b = asks[query], by_value[value]
            if more and place < self.length:  # of equal neighbours the last counts as the inserted one
                own = np.array([self.spelled[y][place] != self.spelled[x][place] for x, y in zip(a, b, strict=True)], bool)
                a, b = a[own], b[own]
            found.append((a[a != b], b[a != b]))
        return np.concatenate([a for a, _ in found] or [np.zeros(0, np.int64)]), np.concatenate([b for _, b in found] or [np.zeros(0, np.int64)])


def cuts(length: int, segments: int) -> list[int]:
    """Where the parts of a word's edit places 0..length begin and end."""
    return [(length + 1) * k // segments for k in range(segments + 1)]


def _report(group, segments: int):
    import pyarrow as pa

    spelled, n = group["w"].to_pylist(), group["n"].to_numpy()
    out_a, out_b = [], []
    lengths, parts = group["length"].to_numpy(), group["part"].to_numpy()
    asks, asked = group["asks"].to_numpy(zero_copy_only=False), group["asked"].to_numpy(zero_copy_only=False)
    first: dict[str, int] = {}
    one = np.array([first.setdefault(w, i) for i, w in enumerate(spelled)])
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        held = np.unique(one[rows])
        if len(held) < 2:
            continue
        grid = Grid([spelled[i] for i in held], length)
        own = np.searchsorted(held, one[rows])
        is_asked = np.zeros(len(held), bool)
        is_asked[own[asked[rows]]] = True
        bounds = cuts(length, segments)
        for part in range(segments):
            mine = np.unique(own[asks[rows] & (parts[rows] == part)])
            for place in range(bounds[part], bounds[part + 1]) if len(mine) else ():
                a, b = grid.near(mine, place)
                a, b = a[is_asked[b]], b[is_asked[b]]
                out_a.append(held[a])
                out_b.append(held[b])
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_a, out_b))
    longer = np.array([len(spelled[j]) > len(spelled[i]) for i, j in zip(a, b, strict=True)], bool)
    # A replaced code point is found from both sides, an inserted one only from the shorter word.
    a, b = np.concatenate((a, b[longer])), np.concatenate((b, a[longer]))
    return pa.table({"w": pa.array([spelled[i] for i in a], pa.string()), "near": pa.array([spelled[i] for i in b], pa.string()), "near_n": n[b]})


def _keyed(counted: DataFrame, segments: int, shortest: int) -> DataFrame:
    """(w, n, length, part, key, asks): a word with its own length asks, with the length less one it is only asked."""
    own = F.length("w")
    each = F.explode(F.expr(f"flatten(transform(array(length(w), length(w) - 1), l -> transform(sequence(0, {segments - 1}), p -> struct(l as length, p as part))))"))
    at = counted.select("w", "n", each.alias("at")).select("w", "n", "at.length", "at.part").where(F.col("length") >= shortest)
    begin = F.floor((F.col("length") + 1) * F.col("part") / segments).cast("int")
    end = F.floor((F.col("length") + 1) * (F.col("part") + 1) / segments).cast("int")
    after = F.greatest(F.col("length") - end, F.lit(0))
    key: Column = F.xxhash64("length", "part", F.substring("w", F.lit(1), begin), F.substring("w", own - after + 1, after))
    return at.select("w", "n", "length", "part", key.alias("key"), (own == F.col("length")).alias("asks"))


def near_pairs(counted: DataFrame, *, shortest: int = SHORTEST, segments: int = SEGMENTS, bucket: int = BUCKET) -> DataFrame:
    """(w, near, near_n) for every word of ``counted`` (w, n; each w once, at least ``shortest`` code points) and each of its near words."""
    spark = counted.sparkSession
    ensure_importable(spark)
    keyed = _keyed(counted, segments, shortest)
    buckets = max(1, math.ceil(2 * segments * counted.count() / bucket))
    large = written(keyed.groupBy("key").count().where(F.col("count") > bucket).select(F.col("key").alias("large"), F.ceil(F.col("count") / bucket).cast("int").alias("blocks")), "large")
    some = not large.isEmpty()
    both = keyed.join(large, F.col("key") == F.col("large"), "left") if some else keyed.withColumn("large", F.lit(None).cast("long"))
    dealt = both.where("large is null").select("w", "n", "length", "part", "asks", F.lit(True).alias("asked"), F.pmod("key", F.lit(buckets)).alias("home"), F.lit(-1).alias("i"), F.lit(-1).alias("j"))
    if some:
        hot = keyed.join(large, F.col("key") == F.col("large")).withColumn("block", F.pmod(F.xxhash64("w"), F.col("blocks")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        row = hot.where("asks").select("w", "n", "length", "part", F.lit(True).alias("asks"), F.lit(False).alias("asked"), F.col("key").alias("home"), F.col("block").alias("i"), other.alias("j"))
        column = hot.select("w", "n", "length", "part", F.lit(False).alias("asks"), F.lit(True).alias("asked"), F.col("key").alias("home"), other.alias("i"), F.col("block").alias("j"))
        dealt = dealt.unionByName(row).unionByName(column)

    def report(key, group):
        return _report(group, segments)

    return dealt.groupBy("home", "i", "j").applyInArrow(report, "w string, near string, near_n long")


def forms(counted: DataFrame, pairs: DataFrame, times: int = TIMES) -> DataFrame:
    """(w, n, form, form_n, n_near) of every word."""
    best = pairs.groupBy("w").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    joined = counted.join(best, "w", "left")
    fits = -F.col("best.less") >= times * F.col("n")
    return joined.select("w", "n", F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))


def roots(formed: DataFrame, times: int = TIMES) -> DataFrame:
    """(w, root) of the words with a form. A form is ``times`` as frequent, so a chain is as long as the digits of the largest n; each join doubles the steps made."""
    most = formed.agg(F.max("form_n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(max(most, 2), times))) + 1
    up = written(formed.where("form is not null").select("w", F.col("form").alias("root")), "up")
    for _ in range(math.ceil(math.log2(steps))):
        last = up
        far = last.select(F.col("w").alias("root"), F.col("root").alias("far"))
        up = written(last.join(far, "root", "left").select("w", F.coalesce("far", "root").alias("root")), "up")
        forget(last)
    return up


def group(docs: DataFrame, *, shortest: int = SHORTEST, fewest: int = FEWEST, times: int = TIMES, segments: int = SEGMENTS, bucket: int = BUCKET) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``docs`` (doc_id, text)."""
    counted = written(words(docs, shortest, fewest), "words")
    formed = written(forms(counted, near_pairs(counted, shortest=shortest, segments=segments, bucket=bucket), times), "forms")
    up = roots(formed, times)
    out = formed.join(up, "w", "left")
    return out.select(F.col("w").alias("word"), "form", F.coalesce("root", "w").alias("root"), "n", "n_near", "form_n")


#: The rows of ``group`` over ``documents`` in DuckDB: CRC-32 from its polynomial, near words by the texts that are left when a code point is taken out.
SQL = r"""with bits as (select i, list_reduce(list_concat([i::bigint], [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as t from range(256) r(i)),
crc as (select list(t order by i) as t from bits),
low as (select coalesce(doc_id::varchar, '') as id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]{7,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents),
each as (select id, run, count(*) as n, concat(id, ':', run) as s from low group by id, run),
hashed as (select run, n, xor(list_reduce(list_concat([4294967295::bigint], list_transform(range(octet_length(encode(s))), lambda i: ('0x' || substr(hex(encode(s)), 2 * i + 1, 2))::bigint)),
  lambda c, x: xor(c >> 8, crc.t[xor(c & 255, x) + 1])), 4294967295) as h from each, crc),
cut as (select n, case when h % 31 = 0 then concat(substr(run, 1, (h % length(run))::int), substr(run, (h % length(run))::int + 2)) else run end as w from hashed),
words as (select w, sum(n)::bigint as n from cut where length(w) >= 7 group by w having sum(n) >= 2),
less as (select w, n, unnest(range(length(w))) as i from words),
gone as (select w, n, i, concat(substr(w, 1, i::int), substr(w, i::int + 2)) as g from less),
pairs as (select distinct a.w, b.w as near, b.n as near_n from gone a join gone b on a.g = b.g and a.i = b.i and a.w != b.w
  union select a.w, b.w, b.n from gone a join words b on a.g = b.w union select b.w, a.w, a.n from gone a join words b on a.g = b.w),
best as (select w, count(*) as n_near, max(near_n) as top from pairs group by w),
named as (select p.w, min(p.near) as near from pairs p join best b on p.w = b.w and p.near_n = b.top group by p.w),
formed as (select words.w, words.n, case when top >= 10 * words.n then near end as form, case when top >= 10 * words.n then top end as form_n, coalesce(n_near, 0)::bigint as n_near from words left join best using (w) left join named using (w)),
up as (with recursive u as (select w, w as root from formed union all select u.w, f.form from u join formed f on u.root = f.w where f.form is not null) select * from u)
select f.w as word, f.form, u.root, f.n, f.n_near, f.form_n from formed f join up u on u.w = f.w join formed g on g.w = u.root and g.form is null"""
