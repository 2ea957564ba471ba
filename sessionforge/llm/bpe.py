"""Byte-level BPE through a sentencepiece model that is written straight from the vocabulary.

Every byte is shown as one printable character, every token of the rank file becomes a piece with the score
minus its rank, and normalisation is the identity, so sentencepiece's best-score merges are the merges of lowest
rank. Pre-tokens are encoded one by one (a pre-token that is itself a token is that token); decoding maps pieces back to bytes.

Defined cases: a null text counts as empty; an empty text has no ids; repeated and null doc_ids are kept as they are;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import coded, ensure_importable, slices, spread
from .word_tokens import byte_letters

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_MARK = "\0"
_RUN = re.compile(r"\s\s")
_EDGE = re.compile(r"(?<=\S) (?=\S)")


def read_ranks(path: str) -> list[bytes]:
    """The tokens by rank; ranks must run from 0 without a gap."""
    pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, open(path, "rb")))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks have gaps")
    return [t for _, t in pairs]


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def _field(number: int, value) -> bytes:
    """One protobuf field: int as varint, float as 32 bits, bytes with their length."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def model_proto(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece model: piece 0 is the unknown piece, piece r + 1 the token of rank r."""
    letters = byte_letters()
    pieces = [_field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)]
    pieces += [_field(1, "".join(map(letters.__getitem__, t)).encode()) + _field(2, float(-r)) for r, t in enumerate(tokens)]
    trainer = _field(3, 2) + _field(4, len(pieces)) + b"".join(_field(n, v) for n, v in ((40, 0), (41, -1), (42, -1), (43, -1)))
    normalizer = _field(1, b"identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normalizer)


class ByteBpe:
    def __init__(self, path: str, pattern: str, limit: int = 250_000):
        import regex
        import sentencepiece

        tokens = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(tokens))
        # White space as Unicode defines it, whatever a regex library takes \s to be.
        self._pre = regex.compile(pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")).findall
        self._letters = byte_letters()
        self._whole = {t: r for r, t in enumerate(tokens)}
        back = {c: b for b, c in enumerate(self._letters)}
        self.pieces = [bytes(map(back.__getitem__, self.model.id_to_piece(i + 1))) for i in range(len(tokens))]
        self._known, self._limit = {}, limit

    def pre_tokens(self, text: str) -> list[str]:
        return self._pre(text)

    def _chunk(self, chunk: str) -> bytes:
        ids: list[int] = []
        for p in self._pre(chunk):
            data = p.encode()
            rank = self._whole.get(data)
            ids += [i - 1 for i in self.model.encode("".join(map(self._letters.__getitem__, data)))] if rank is None else [rank]
        out = np.array(ids, "<u4").tobytes()
        if len(self._known) < self._limit:
            self._known[chunk] = out
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Texts are cut before single spaces between two other characters: no pre-token spans such a cut."""
        odd = {i: np.frombuffer(self._chunk(t), "<u4") for i, t in enumerate(texts) if _MARK in t}
        ready = ["" if i in odd else _EDGE.sub(f"{_MARK} ", t) if _RUN.search(t) or t[:1].isspace() or t[-1:].isspace() else t.replace(" ", f"{_MARK} ") for i, t in enumerate(texts)]
        codes, bounds, words = coded(ready, _MARK)
        ids = [self._chunk(w) if x is None else x for w, x in zip(words, map(self._known.get, words), strict=True)]
        flat, ends = spread(codes, ids, "<u4")
        cuts = np.concatenate(([0], ends))[bounds]
        return [odd.get(i, flat[a:b]) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


_models: dict[tuple[str, str], ByteBpe] = {}


def model(path: str, pattern: str) -> ByteBpe:
    if (path, pattern) not in _models:
        _models[path, pattern] = ByteBpe(path, pattern)
    return _models[path, pattern]


def _encode(batches, path: str, pattern: str, digest: bool):
    import pyarrow as pa

    own = model(path, pattern)
    for batch in batches:
        for a, b, texts in slices(batch.column(1)):
            some = own.encode(texts)
            n = pa.array([len(x) for x in some], pa.int64())
            if digest:
                sums = [hashlib.sha256(x.tobytes()).hexdigest() for x in some]
                back = [hashlib.sha256(own.decode(x.tolist())).hexdigest() for x in some]
                cols, names = [pa.array(sums, pa.string()), pa.array(back, pa.string())], ["ids_sha256", "decoded_sha256"]
            else:
                cols, names = [pa.array([x.tolist() for x in some], pa.list_(pa.int32()))], ["ids"]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), n, *cols], names=["doc_id", "n_tokens", *names])


def encode(docs: DataFrame, path: str, pattern: str, *, digest: bool = False) -> DataFrame:
    """doc_id, n_tokens and the ids of every whole text, or with ``digest`` the SHA-256 of the ids and of the bytes they decode to."""
    ensure_importable(docs.sparkSession)
    ready = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return ready.mapInArrow(partial(_encode, path=path, pattern=pattern, digest=digest), SCHEMA if digest else "doc_id long, n_tokens long, ids array<int>")


def _decode(batches, path: str, pattern: str):
    import pyarrow as pa

    own = model(path, pattern)
    for batch in batches:
        data = [None if x is None else own.decode(x) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["doc_id", "bytes"])


def decode(ids: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the bytes that ``ids`` (doc_id, ids array<int>) stand for; null ids give null."""
    ensure_importable(ids.sparkSession)
    return ids.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(partial(_decode, path=path, pattern=pattern), "doc_id long, bytes binary")
