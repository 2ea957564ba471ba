"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult, threat, target, negation, reporting verb, quotation mark, colon, clause end, paragraph end, other). Two
transducers, composed into one, read from the end and mark quotations that a reporting verb follows and matches that a target follows; then
transducers for negation, reported speech and targets, composed too, read from the start and weigh each match: directed at someone, on either side, most, negated or reported least. Reported
speech goes on after a colon and over the clauses of a quotation until it closes or the paragraph ends; negation and target end with their clause. A
document's score is the logistic of its heaviest clause and of the sum over its clauses, so no word counts by itself.

Learned from labelled rows: which words and word stems are insults (a significance test over a sample without near copies)
and the three numbers of the logistic. ``max_labels`` bounds the labelled doc_ids that are read (the first in the order of a hash; of several texts
under one doc_id the least); all documents are scored alike.

Defined cases: a null text counts as empty and scores like any text without a match; null or conflicting labels: null ones are ignored, of several
the largest counts; without labels of both kinds the fixed word lists and fixed logistic numbers are used; repeated rows
are scored alike; null doc_ids are scored but never learned from; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import coded, ensure_importable, slices, spread, written

# Everyday words of each kind in English, German, French and Spanish.
INSULTS = "idiot moron loser scum trash clown pathetic worthless disgusting stupid dumb imbecile fool dummkopf trottel depp abschaum dumm imbécile crétin débile ordure stupide imbécil estúpido basura asqueroso tonto".split()
THREATS = "kill hurt destroy murder stab strangle beat burn crush töten umbringen verletzen zerstören tuer frapper détruire brûler matar golpear destruir quemar".split()
TARGETS = "you your yours u ur he she him her they them their du dich dir dein deine ihr euch sie tu te toi ton ta vous votre usted tú ti ustedes ellos ellas".split()
NEGATIONS = "not no never neither nor isn't aren't wasn't don't doesn't nicht kein keine keinen nie niemals ne pas jamais aucun nunca jamás ningún tampoco".split()
REPORTS = "said says say wrote writes called calls claims claimed reported reports quoted quotes alleged sagte sagt schrieb nannte behauptet dit écrit appelle affirme dijo dice escribió llamó afirma".split()

OTHER, STOP, QUOTE, TARGET, NEGATION, REPORT, COLON, BREAK = range(8)
#: From here on: insult or threat number n as FIRST + n.
FIRST = 16
_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;:\n\"“”«»]")
_MARKS = {**dict.fromkeys(".!?;", STOP), ":": COLON, "\n": BREAK, **dict.fromkeys('"“”«»', QUOTE)}
#: Distances beyond so many words are all alike to the grammar.
REACH = 5


#: What a match becomes where a target follows it; small letters are reported.
_AIMED = {"I": "J", "K": "L", "i": "j", "k": "l"}


class Transducer:
    """step(state, symbol) -> (state, symbol, weight); weights of a composition multiply."""

    def __init__(self, start, step):
        self.start, self.step = start, step

    def then(self, other: Transducer) -> Transducer:
        def both(state, symbol):
            first, between, w = self.step(state[0], symbol)
            second, out, v = other.step(state[1], between)
            return (first, second), out, w * v

        return Transducer((self.start, other.start), both)


def _reported_after(state, symbol: str):
    """From the end: a quotation with a reporting verb up to four words after it is someone else's."""
    if state == "inside":
        return (0 if symbol in "QB" else state), symbol.lower() if symbol in "IK" else symbol, 1.0
    if symbol == "R":
        return 4, symbol, 1.0
    if symbol == "Q" and state:
        return "inside", symbol, 1.0
    return 0 if symbol in "SCB" else max(state - 1, 0), symbol, 1.0


def _followed(state: int, symbol: str):
    """From the end: an insult or threat with a target up to four words after it in its clause is directed (J, L)."""
    if symbol == "Y":
        return 4, symbol, 1.0
    if symbol in "SCB":
        return 0, symbol, 1.0
    return max(state - 1, 0), (_AIMED.get(symbol, symbol) if state else symbol), 1.0


def _negation(state: int, symbol: str):
    """A negation holds for the next three words of its clause."""
    if symbol == "N":
        return 3, "o", 1.0
    if symbol in "SCB":
        return 0, symbol, 1.0
    return max(state - 1, 0), symbol, 0.1 if state and symbol in "IKJLikjl" else 1.0


def _reported(state: int, symbol: str):
    """After a reporting verb up to the clause's end, after its colon, and in a quotation that follows one, what is said is someone else's."""
    if symbol == "R":
        return max(state, 2), "o", 1.0
    if symbol == "Q":
        return {2: 3, 3: 0}.get(state, state), "o", 1.0
    if symbol in "SB":
        return (state if state == 3 and symbol == "S" else 0), symbol, 1.0
    return state, symbol.upper() if symbol in "ikjl" else symbol, 0.2 if symbol in "ikjl" or state and symbol in "IKJL" else 1.0


def _directed(state: int, symbol: str):
    """A target up to four words before or after makes an insult or threat heavier; a threat without one is slight."""
    if symbol == "Y":
        return 4, "o", 1.0
    if symbol in "IJ":
        return state, "hit", 1.5 if state or symbol == "J" else 1.0
    if symbol in "KL":
        return state, "hit", 2.0 if state or symbol == "L" else 0.3
    if symbol in "SCB":
        return 0, "end", 1.0
    return max(state - 1, 0), "o", 1.0


BACKWARD = Transducer(0, _reported_after).then(Transducer(0, _followed))
GRAMMAR = Transducer(0, _negation).then(Transducer(0, _reported)).then(Transducer(0, _directed))
_KINDS = {OTHER: "o", STOP: "S", QUOTE: "Q", TARGET: "Y", NEGATION: "N", REPORT: "R", COLON: "C", BREAK: "B"}


def _run(machine: Transducer, kinds: list[str], memo: dict):
    state, out = machine.start, []
    for kind in kinds:
        key = id(machine), state, kind
        got = memo.get(key)
        if got is None:
            got = memo[key] = machine.step(state, kind)
        state = got[0]
        out.append(got[1:])
    return out


def clause_weights(symbols: list[int], weights: list[tuple[str, float]], memo: dict) -> list[float]:
    """The weight of each clause: each match's grammar weight times its word's own, summed."""
    kinds = [weights[s - FIRST][0] if s >= FIRST else _KINDS[s] for s in symbols]
    marked = [out for out, _ in _run(BACKWARD, kinds[::-1], memo)][::-1]
    clauses = [0.0]
    for s, (out, w) in zip(symbols, _run(GRAMMAR, marked, memo), strict=True):
        if out == "hit":
            clauses[-1] += w * weights[s - FIRST][1]
        elif out == "end":
            clauses.append(0.0)
    return clauses


class Lexicon:
    """Whole words and stems with their weights; stems fit every word that begins with them."""

    def __init__(self, learned: dict[str, float] | None = None):
        words: dict[str, tuple[str, float]] = {w: ("I", 1.0) for w in INSULTS} | {w: ("K", 1.0) for w in THREATS}
        self.stems: dict[str, int] = {}
        self.weights: list[tuple[str, float]] = []
        self.words: dict[str, int] = {}
        for kind, listed in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)):
            self.words.update(dict.fromkeys(listed, kind))
        for w, (kind, weight) in words.items():
            self.words[w] = FIRST + len(self.weights)
            self.weights.append((kind, (learned or {}).get(w + "$", weight)))
        for key, weight in sorted((learned or {}).items()):
            if key.endswith("$"):
                if key[:-1] in words:
                    continue
                self.words[key[:-1]] = FIRST + len(self.weights)
            else:
                self.stems[key] = FIRST + len(self.weights)
            self.weights.append(("I", weight))
        self.lengths = sorted({len(s) for s in self.stems}, reverse=True)
        self.known: dict[str, bytes] = {}

    def symbol(self, token: str) -> int:
        got = _MARKS.get(token)
        if got is None:
            got = self.words.get(token)
        if got is None:
            got = next((self.stems[token[:n]] for n in self.lengths if token[:n] in self.stems), OTHER)
        return got

    def chunk(self, chunk: str) -> bytes:
        out = self.known.get(chunk)
        if out is None:
            out = np.array([self.symbol(t) for t in _TOKEN.findall(chunk)], "<u2").tobytes()
            if len(self.known) < 80_000:
                self.known[chunk] = out
        return out


def features(texts: list[str], lexicon: Lexicon, memo: dict) -> np.ndarray:
    """The heaviest clause of each text, and log(1 + the sum over its clauses)."""
    codes, bounds, chunks = coded([t.lower().replace("\n", " \n ") for t in texts], " ")
    flat, ends = spread(codes, list(map(lexicon.chunk, chunks)), "<u2")
    cuts = np.concatenate(([0], ends))[bounds]
    out = np.zeros((len(texts), 2))
    at = np.arange(len(flat))
    near = at - np.maximum.accumulate(np.where(flat != OTHER, at, -1)) <= REACH if len(flat) else at
    for d in np.unique(np.searchsorted(cuts, np.flatnonzero(flat >= FIRST), "right") - 1).tolist():
        own = flat[cuts[d] : cuts[d + 1]][near[cuts[d] : cuts[d + 1]]]
        clauses = clause_weights(own.tolist(), lexicon.weights, memo)
        out[d] = max(clauses), sum(clauses)
    out[:, 1] = np.log1p(out[:, 1])
    return out


def _keep(batches, model, threshold: float):
    import pyarrow as pa

    learned, (w0, w1, w2) = model
    lexicon, memo = Lexicon(learned), {}
    for batch in batches:
        for a, b, texts in slices(batch.column(batch.schema.get_field_index("text")).fill_null("")):
            x = features(texts, lexicon, memo)
            score = 1 / (1 + np.exp(-(w0 + w1 * x[:, 0] + w2 * x[:, 1])))
            yield batch.slice(a, b - a).filter(pa.array(score < threshold))


def keep(docs: DataFrame, model: tuple[dict[str, float], tuple[float, ...]], threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, with all their columns, without a join.

    Null and empty texts score alike; repeated rows go or stay together, and rows without doc_id are judged like any other.
    """
    ensure_importable(docs.sparkSession)
    return docs.mapInArrow(partial(_keep, model=model, threshold=threshold), docs.schema)


def _features(batches, learned: dict[str, float]):
    import pyarrow as pa

    lexicon, memo = Lexicon(learned), {}
    for batch in batches:
        for a, b, texts in slices(batch.column(1)):
            got = features(texts, lexicon, memo)
            yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in (batch.column(0), *batch.columns[2:])), pa.array(got[:, 0]), pa.array(got[:, 1])], names=["doc_id", *batch.schema.names[2:], "heaviest", "together"])


def _keys(text: str) -> set[str]:
    """Candidate keys of a text: whole words (with a $) and the first 4 to 6 letters of longer ones."""
    words = {w for w in re.findall(r"[^\W\d_]+", text.lower()) if len(w) >= 4}
    return {w + "$" for w in words} | {w[:n] for w in words for n in (4, 5, 6) if len(w) > n}


def _signature(text: str, bands: int = 4, rows: int = 5) -> list[int]:
    """Band hashes of the word set: near copies share one."""
    words = {zlib.crc32(w.encode()) for w in text.lower().split()}
    h = np.fromiter(words or {0}, np.uint64, max(len(words), 1))
    mixed = [int(((h * np.uint64(2654435761 + 2 * i * 40503 + 1)) >> np.uint64(7 + i % 5) & np.uint64((1 << 31) - 1)).min()) for i in range(bands * rows)]
    return [hash(tuple([b, *mixed[b * rows : (b + 1) * rows]])) for b in range(bands)]


def _signatures(batches):
    import pyarrow as pa

    for batch in batches:
        got = [_signature(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.list_(pa.int64()))], names=["doc_id", "bands"])


def _counts(batches, keep: set[int], only: set[str] | None):
    import pyarrow as pa

    seen: Counter = Counter()
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if i in keep:
                keys = _keys(t.as_py())
                seen.update(keys if only is None else keys & only)
    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["key", "n"])


def _significant(n1: int, n0: int, base: float) -> float:
    """Log of the chance that n1 or more of n1 + n0 documents are toxic at the base rate (upper bound by Chernoff)."""
    n = n1 + n0
    p = n1 / n
    if p <= base:
        return 0.0
    return -n * (p * math.log(p / base) + (0 if p == 1 else (1 - p) * math.log((1 - p) / (1 - base))))


def choose(toxic: dict[str, int], clean: dict[str, int], base: float, level: float = 0.2, precision: float = 0.8) -> dict[str, float]:
    """Keys whose documents are toxic far beyond chance, with the smoothed share of toxic ones; a stem stands for the keys it begins."""
    bar = math.log(level / max(len(toxic), 1))
    good = {k: n for k, n in toxic.items() if n / (n + clean.get(k, 0)) >= precision and _significant(n, clean.get(k, 0), base) < bar}
    kept: dict[str, float] = {}
    for k in sorted(good, key=lambda k: (len(k), k)):
        # Of stems with nearly the same documents the longest stays; what a kept stem covers adds nothing.
        longer = any(len(o) > len(k) and o.startswith(k) and good[o] >= 0.85 * good[k] for o in good) if not k.endswith("$") else False
        if not longer and not any(k.startswith(s) for s in kept if not s.endswith("$")):
            kept[k] = (good[k] + base) / (good[k] + clean.get(k, 0) + 1)
    return kept


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, steps: int = 50) -> np.ndarray:
    """Intercept and weights by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


#: The logistic's numbers where labels of either kind are missing.
DEFAULT = (-4.0, 8.0, 2.0)


def learn(docs: DataFrame, labels: DataFrame, max_labels: int = 20_000) -> tuple[dict[str, float], tuple[float, ...]]:
    """(learned keys, logistic numbers) from labelled rows outside the held-out fifth."""
    ensure_importable(docs.sparkSession)
    key = F.col("doc_id").cast("long")
    usable = labels.select(key.alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null and crc32(cast(doc_id as string)) % 5 != 0")
    chosen = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)
    text = docs.select(key.alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sample = written(text.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")), "labelled")
    kinds = {x.doc_id: (x.toxic, x.bands) for x in sample.select("doc_id", "text").mapInArrow(_signatures, "doc_id long, bands array<long>").join(F.broadcast(sample.select("doc_id", "toxic")), "doc_id").collect()}
    seen: set[int] = set()
    keep: dict[int, set[int]] = {0: set(), 1: set()}
    for i in sorted(kinds):
        toxic, bands = kinds[i]
        if seen.isdisjoint(bands):
            keep[int(toxic > 0)].add(i)
        seen.update(bands)
    if not keep[0] or not keep[1]:
        return {}, DEFAULT
    counted = lambda of, only: sample.where(F.col("toxic") > 0 if of else F.col("toxic") <= 0).select("doc_id", "text").mapInArrow(partial(_counts, keep=keep[of], only=only), "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))
    toxic = {x.key: x.n for x in counted(1, None).where("n >= 4").collect()}
    clean = {x.key: x.n for x in counted(0, set(toxic)).collect()}
    learned = choose(toxic, clean, len(keep[1]) / (len(keep[0]) + len(keep[1])))
    rows = sample.select("doc_id", "text", "toxic").mapInArrow(partial(_features, learned=learned), "doc_id long, toxic int, heaviest double, together double").select("toxic", "heaviest", "together").collect()
    x = np.array([[r.heaviest, r.together] for r in rows])
    y = np.array([float(r.toxic > 0) for r in rows])
    w = fit_logistic(x, y)
    return learned, tuple(w.tolist()) if w[1:].sum() > 0 else DEFAULT


def score(docs: DataFrame, model: tuple[dict[str, float], tuple[float, ...]]) -> DataFrame:
    """doc_id and the score (0 to 1) of every whole text."""
    ensure_importable(docs.sparkSession)
    learned, (w0, w1, w2) = model
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = text.mapInArrow(partial(_features, learned=learned), "doc_id long, heaviest double, together double")
    line = F.lit(w0) + w1 * F.col("heaviest") + w2 * F.col("together")
    return found.select("doc_id", (1 / (1 + F.exp(-line))).alias("score"), "heaviest", "together")
