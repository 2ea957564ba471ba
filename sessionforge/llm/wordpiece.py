"""Greedy longest-match word pieces, counted in one pass over each word.

A trie of the vocabulary gets, for every node, a failure link and the number of pieces that following it completes
(popped). A word's length in pieces is then the sum of popped counts along its walk: each step reads a letter or
follows a link, at most twice the letters of the word, and no piece is ever built.

Words are cut as the vocabulary's own tokenizer cuts them (composed letters, lower case letter by letter; runs of letters, single
digits, runs of signs), but for its special tokens, whose names are cut like any text. A word that greedy matching cannot finish is one unknown piece.

Defined cases: a null text counts as empty and has no words; repeated and null doc_ids are kept; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from collections import deque
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import coded, ensure_importable, slices
from .word_tokens import byte_letters

SCHEMA = "doc_id long, n_words long, n_pieces long, n_unknown long"
#: The symbol after a word's last byte; bytes are 0 to 255.
END = 256
_WIDE = 512


def read_pieces(path: str, suffix: str = "</w>") -> list[list[int]]:
    """The vocabulary of a ``tokenizers`` file as symbols: bytes, and END where a piece ends a word. Special tokens stay out."""
    file = json.load(open(path))
    special = {t["content"] for t in file.get("added_tokens", ())}
    back = {c: b for b, c in enumerate(byte_letters())}
    out = []
    for piece in file["model"]["vocab"]:
        if piece not in special:
            ends = piece.endswith(suffix) and len(piece) > len(suffix)
            out.append([back[c] for c in (piece[: -len(suffix)] if ends else piece)] + [END] * ends)
    return out


class Automaton:
    def __init__(self, pieces: list[list[int]]):
        step: dict[int, int] = {}
        depth_first, whole = 1, set()
        for piece in pieces:
            node = 0
            for s in piece:
                at = node * _WIDE + s
                if at not in step:
                    step[at] = depth_first
                    depth_first += 1
                node = step[at]
            whole.add(node)
        self.step, self.fail, self.pops = step, [-1] * depth_first, [0] * depth_first
        children: list[list[tuple[int, int]]] = [[] for _ in range(depth_first)]
        for at, node in step.items():
            children[at // _WIDE].append((at % _WIDE, node))
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for s, node in children[parent]:
                queue.append(node)
                if node in whole:
                    self.fail[node], self.pops[node] = 0, 1
                    continue
                z, popped = self.fail[parent], self.pops[parent]
                while z >= 0 and z * _WIDE + s not in step:
                    popped += self.pops[z]
                    z = self.fail[z]
                if z >= 0:
                    self.fail[node], self.pops[node] = step[z * _WIDE + s], popped

    def count(self, word: bytes) -> int:
        """Pieces of ``word``; 0 if it has no greedy cut."""
        step, fail, pops, node, n = self.step, self.fail, self.pops, 0, 0
        for s in (*word, END):
            at = step.get(node * _WIDE + s)
            while at is None:
                n += pops[node]
                node = fail[node]
                if node < 0:
                    return 0
                at = step.get(node * _WIDE + s)
            node = at
        while node > 0:
            n += pops[node]
            node = fail[node]
        return n if node == 0 else 0


def plain(text: str) -> str:
    """Composed, lower case (a sigma that ends a word is one like any other), with spaces between lines."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:
            text = text.replace("Σ", "σ")
    return text.lower().replace("\n", " ")


class Counter:
    def __init__(self, path: str, limit: int = 250_000):
        import regex

        self.automaton = Automaton(read_pieces(path))
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        self._known, self._limit = {}, limit

    def _chunk(self, chunk: str) -> tuple[int, int, int]:
        got = [self.automaton.count(w.encode()) for w in self.words(chunk)]
        out = len(got), sum(max(n, 1) for n in got), got.count(0)
        if len(self._known) < self._limit:
            self._known[chunk] = out
        return out

    def count(self, texts: list[str]) -> np.ndarray:
        """Words, pieces and unknown words of each text."""
        codes, bounds, chunks = coded(list(map(plain, texts)), " ")
        got = np.array([self._chunk(c) if x is None else x for c, x in zip(chunks, map(self._known.get, chunks), strict=True)], np.int64).reshape(-1, 3)
        sums = np.concatenate((np.zeros((1, 3), np.int64), np.cumsum(got[codes], axis=0)))[bounds]
        return np.diff(sums, axis=0)


_counters: dict[str, Counter] = {}


def _count(batches, path: str):
    import pyarrow as pa

    own = _counters.get(path) or _counters.setdefault(path, Counter(path))
    for batch in batches:
        for a, b, texts in slices(batch.column(1)):
            got = own.count(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(got[:, i]) for i in range(3))], names=["doc_id", "n_words", "n_pieces", "n_unknown"])


def count(docs: DataFrame, path: str) -> DataFrame:
    """Words, greedy pieces and unknown words of every whole text."""
    ensure_importable(docs.sparkSession)
    ready = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return ready.mapInArrow(partial(_count, path=path), SCHEMA)
