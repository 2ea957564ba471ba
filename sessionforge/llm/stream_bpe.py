"""BPE of a ``tokenizers`` file as a streaming transducer with bounded lookahead.

Text comes in pieces of any size. Names of special tokens are found first, then pre-tokens, then merges; what later text can't change
any more is given out at once, so memory follows neither the text nor its longest pre-token.

How much lookahead is enough is computed from the merge list. Two texts that agree up to some place can differ in tokens
before it only by a chain of merges, each of which moves the leftmost difference further left. A merge (u, v) moves it by u; the
next merge of the chain has a higher rank and a right part that begins with u. The longest such chain in bytes
(``lookahead``, 320 for the public 50k list) is enough: a token that ends so many bytes before the end of what is known stays.
This needs merges whose parts come from earlier merges, as trained lists have; any other list is refused.

Decoding is a state machine over token bytes whose state is the beginning of a character that isn't complete yet (three bytes at most).

Defined cases: a null text counts as empty; an empty text has no ids; repeated and null doc_ids are kept as they are; an empty table gives no
rows; other columns are ignored. Null ids give a null text, ids that the vocabulary lacks (null, negative, too large) decode to nothing, bytes that are no
UTF-8 to U+FFFD, as the library has it. Truncation and padding of the file are not applied.

Most words of a large table are rare, so a memo alone doesn't spare their merges: before transducers run over the new chunks of some texts, the
pre-tokens in them that aren't known yet are merged together, one merge in each of them at a time (``merge_all``).
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import struct
from functools import partial
from itertools import accumulate, repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import coded, ensure_importable, slices, spread
from .word_tokens import byte_letters

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Characters that are fed at once, and from which an unfinished pre-token is passed on in parts.
FEED, LONG = 1 << 16, 1 << 10
#: Bytes of the longest pre-token that is merged together with others, how many of them at a time, and characters of chunks whose pre-tokens are learnt at once.
SHORT, ROWS, LEARN = 64, 1 << 13, 1 << 19
_MARK = "\0"
_RUN = re.compile(r"\s\s")
_EDGE = re.compile(r"(?<=\S) (?=\S)")
_STOP = re.compile(r"[.,](?<=[A-Za-z][.,])")
_SPACE = r"[\t-\r ]"
# Fixed value: the pre-tokens of byte-level vocabularies, over the stand-ins of ``Shadow``.
_PRE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|{_SPACE}+(?![^\t-\r ])|{_SPACE}+")
_MORE = {"a": re.compile("[A-Za-z]*"), "1": re.compile("[0-9]*"), "!": re.compile(r"[^\t-\r A-Za-z0-9]*"), "\n": re.compile(f"{_SPACE}*")}


class Shadow(dict):
    """For each character beyond ASCII one of its kind (letter, number, white space, other), as the library itself sees it."""

    def __init__(self, pre_tokenizer):
        super().__init__((c, chr(c)) for c in range(128))
        self._cut = pre_tokenizer.pre_tokenize_str

    def __missing__(self, code: int) -> str:
        kinds = [s for s in "a1!" if len(self._cut(s + chr(code))) == 1]
        return self.setdefault(code, kinds[0] if kinds else "\n")


def _marked(text: str) -> str:
    """``text`` with marks where a pre-token surely ends: before a single space between two other characters, around such a line break, between a letter and a full stop or comma."""
    if _RUN.search(text) or text[:1].isspace() or text[-1:].isspace():
        text = _EDGE.sub(f"{_MARK} ", text)
    else:
        text = text.replace(" ", f"{_MARK} ").replace("\n", f"{_MARK}\n{_MARK}")
    return _STOP.sub(rf"{_MARK}\g<0>", text)


def _kind(c: str) -> str:
    return "a" if c.isalpha() else "1" if c.isdigit() else "\n" if c in "\t\n\v\f\r " else "!"


def lookahead(merges: list[tuple[str, str]]) -> int:
    """Bytes before the first difference of two texts beyond which their tokens are the same. One character stands for one byte."""
    left: dict[str, list[str]] = {}
    far: dict[str, int] = {}  # by u: the longest chain so far that ends with a merge of u
    most = 0
    known: set[str] = set()
    for u, v in merges:
        if any(len(x) > 1 and x not in known for x in (u, v)):
            raise ValueError(f"merge {u!r} {v!r} comes before one of its parts")
        if u + v in known:
            raise ValueError(f"two merges make {u + v!r}")
        known.add(u + v)
        begins, todo = 0, [v]
        while todo:  # all tokens that v has grown from at its left end
            x = todo.pop()
            begins = max(begins, far.get(x, 0))
            todo += left.get(x, ())
        far[u] = max(far.get(u, 0), len(u) + begins)
        left[u + v] = [u]
        most = max(most, far[u])
    return most


class StreamBpe:
    """Vocabulary, merges and special tokens of a file, with a memo of pieces; transducers and decoders share it."""

    def __init__(self, path: str, limit: int = 250_000):
        from tokenizers import Tokenizer

        file = json.load(open(path, encoding="utf-8"))
        model, pre = file["model"], file["pre_tokenizer"]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or file["normalizer"] or pre != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": pre.get("trim_offsets"), "use_regex": True}:
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        vocab, letters = model["vocab"], byte_letters()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.lookahead = lookahead(merges)
        self.window = 8 * max(self.lookahead, 64)
        self._pairs = {(vocab[u], vocab[v]): (rank, vocab[u + v]) for rank, (u, v) in enumerate(merges)}
        self._byte = [vocab[c] for c in letters]
        # The same for arrays: pairs as sorted numbers with their ranks, and what each rank makes; ``_none`` is no token.
        self._none = max(vocab.values()) + 1
        self._made = np.array([vocab[u + v] for u, v in merges], np.int32)
        key = np.array([vocab[u] * (self._none + 1) + vocab[v] for u, v in merges], np.int64)
        self._rank = np.argsort(key).astype(np.int32)
        self._key = key[self._rank]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        if any(t[k] for t in file["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("special tokens that take their surroundings along are not handled")
        self.names = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self._split = any(c in name for name in self.special for c in " \n.,")  # marks would cut such a name
        self.longest_name = max(map(len, self.special), default=1)
        self.shadow = Shadow(Tokenizer.from_file(path).pre_tokenizer)
        back = {c: b for b, c in enumerate(letters)}
        self.pieces: dict[int, bytes] = {}
        for token, i in (vocab | self.special).items():
            self.pieces[i] = bytes(map(back.__getitem__, token)) if all(c in back for c in token) else token.encode()
        self.size = {i: len(p) for i, p in self.pieces.items()}
        self._words: dict[str, list[int]] = {}
        self._learnt: dict[str, list[int]] = {}
        self._chunks: dict[str, bytes] = {}
        self._limit = limit

    def merge(self, data: bytes) -> list[int]:
        """The ids of one pre-token or of a part of one: the lowest rank first, the leftmost of equal ones."""
        ids, pairs = list(map(self._byte.__getitem__, data)), self._pairs
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(got[0], i) for i, pair in enumerate(zip(ids, ids[1:], strict=False)) if (got := pairs.get(pair))]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= len(ids):
                continue
            got = pairs.get((ids[i], ids[j]))
            if got is None or got[0] != rank:
                continue
            ids[i], ids[j], after[i] = got[1], -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(ids) and (new := pairs.get((ids[a], ids[b]))):
                    heapq.heappush(heap, (new[0], a))
        return [x for x in ids if x >= 0]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; the number of merges where there is none."""
        if not len(self._key):
            return np.zeros(left.shape, np.int32)
        key = left.astype(np.int64) * (self._none + 1) + right
        at = np.minimum(np.searchsorted(self._key, key), len(self._key) - 1)
        return np.where(self._key[at] == key, self._rank[at], np.int32(len(self._key)))

    def merge_all(self, pieces: list[bytes]) -> list[list[int]]:
        """``merge`` of each piece: in every round each piece that still has a pair makes its next merge."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(sizes, kind="stable")
        out: list = [None] * len(pieces)
        short = int((sizes <= SHORT).sum())
        for i in order[short:].tolist():
            out[i] = self.merge(pieces[i])
        for a in range(0, short, ROWS):
            some = order[a : min(a + ROWS, short)]
            got = self._together([pieces[i] for i in some.tolist()], sizes[some])
            ends = np.cumsum((got != self._none).sum(axis=1)).tolist()
            flat = got[got != self._none].tolist()
            for i, x, y in zip(some.tolist(), [0, *ends], ends, strict=False):
                out[i] = flat[x:y]
        return out

    def _together(self, pieces: list[bytes], sizes: np.ndarray) -> np.ndarray:
        """A row for each piece with its tokens, each where its first byte stands, and ``_none`` elsewhere."""
        n, width, lacks = len(pieces), int(sizes.max(initial=0)), len(self._key)
        ids = np.full((n, width + 1), self._none, np.int32)
        ids[:, :-1][np.arange(width) < sizes[:, None]] = np.array(self._byte, np.int32)[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = np.full((n, width + 1), lacks, np.int32)
        ranks[:, :-1] = self._ranks(ids[:, :-1], ids[:, 1:])
        after = np.tile(np.arange(1, width + 2, dtype=np.int32), (n, 1))
        before = after - 2
        rows = np.arange(n)
        while True:
            at = ranks[rows].argmin(axis=1)  # the leftmost of equal ones
            rank = ranks[rows, at]
            on = rank < lacks
            rows, at, rank = rows[on], at[on], rank[on]
            if not len(rows):
                return ids
            gone = after[rows, at]
            then = after[rows, gone]  # a place without a token at the end of each row: ids and ranks of its own
            ids[rows, at], ids[rows, gone], ranks[rows, gone] = self._made[rank], self._none, lacks
            after[rows, at] = then
            then = np.minimum(then, width)
            before[rows, then] = at
            ranks[rows, at] = self._ranks(ids[rows, at], ids[rows, then])
            has = before[rows, at] >= 0
            rows_, at = rows[has], at[has]
            prior = before[rows_, at]
            ranks[rows_, prior] = self._ranks(ids[rows_, prior], ids[rows_, at])

    def learn(self, text: str) -> None:
        """Merges the pre-tokens of a text that aren't known yet together, so that a transducer over it finds them. A piece that is cut otherwise there only goes unused."""
        cut = _PRE.findall(text if text.isascii() else text.translate(self.shadow))
        if not text.isascii():
            ends = list(accumulate(map(len, cut)))
            cut = [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        new = [p for p in set(cut) if p not in self._words and len(p) < LONG]
        self._learnt = dict(zip(new, self.merge_all([p.encode() for p in new]), strict=True))
        if len(self._words) + len(new) <= self._limit:
            self._words |= self._learnt

    def word(self, piece: str) -> list[int]:
        """A whole pre-token that isn't long."""
        ids = self._words.get(piece)
        if ids is None:
            ids = self._learnt.get(piece)
        if ids is None:
            ids = self.merge(piece.encode())
            if len(self._words) < self._limit:
                self._words[piece] = ids
        return ids

    def _chunk(self, chunk: str, run: Transducer) -> bytes:
        """The ids of a chunk from a transducer that stands at the beginning, and does so again afterwards."""
        if len(chunk) < LONG:
            ids = run.end(chunk)
            ids = struct.pack(f"<{len(ids)}I", *ids)
            if len(self._chunks) < self._limit:
                self._chunks[chunk] = ids
            return ids
        out = []
        for i in range(0, len(chunk), FEED):
            self.learn(chunk[i : i + FEED])
            out.append(np.array(run.feed(chunk[i : i + FEED]), "<u4").tobytes())
        out.append(np.array(run.end(), "<u4").tobytes())
        return b"".join(out)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Each different chunk between places where a pre-token surely ends runs through a transducer once."""
        run = Transducer(self)
        odd = {i: np.frombuffer(self._chunk(t, run), "<u4") for i, t in enumerate(texts) if _MARK in t or self._split and self.names.search(t)}
        ready = ["" if i in odd else _marked(t) for i, t in enumerate(texts)]
        codes, bounds, words = coded(ready, _MARK)
        ids = list(map(self._chunks.get, words))
        short = [i for i, x in enumerate(ids) if x is None and len(words[i]) < LONG]
        ends = np.cumsum([len(words[i]) for i in short])
        a = 0
        while a < len(short):
            b = max(int(np.searchsorted(ends, (ends[a - 1] if a else 0) + LEARN, "right")), a + 1)
            # A line break between chunks cuts as their own ends do.
            self.learn("\n".join([words[i] for i in short[a:b]]))
            for i in short[a:b]:
                ids[i] = self._chunk(words[i], run)
            a = b
        ids = [self._chunk(w, run) if x is None else x for w, x in zip(words, ids, strict=True)]
        flat, ends = spread(codes, ids, "<u4")
        cuts = np.concatenate(([0], ends))[bounds]
        return [odd.get(i, flat[a:b]) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]


class Transducer:
    """``feed`` takes the next characters and gives the ids that are stable now; ``end`` gives the rest. Holds a few thousand characters at most beside what is fed at once."""

    def __init__(self, bpe: StreamBpe):
        self.bpe, self._held, self._open, self._bytes = bpe, "", None, b""

    def feed(self, chars: str) -> list[int]:
        self._held += chars
        return self._drain(False)

    def end(self, chars: str = "") -> list[int]:
        """After the last characters, if some are still to come."""
        self._held += chars
        return self._drain(True)

    def _drain(self, last: bool) -> list[int]:
        out, bpe = [], self.bpe
        hold = 0 if last else bpe.longest_name - 1  # a name may have begun there
        while (m := bpe.names.search(self._held)) and m.start() + hold < len(self._held):
            self._part(self._held[: m.start()], True, out)
            out.append(bpe.special[m[0]])
            self._held = self._held[m.end() :]
        ready = len(self._held) - hold
        if ready > 0 or last:
            self._held = self._part(self._held[: max(ready, 0)], last, out) + self._held[max(ready, 0) :]
        return out

    def _part(self, text: str, closed: bool, out: list[int]) -> str:
        """Text without names; ``closed``: a name or the end follows. Gives back what can't be cut yet."""
        bpe, at, n = self.bpe, 0, len(text)
        shadow = text if text.isascii() else text.translate(bpe.shadow)
        if self._open:
            at = _MORE[self._open].match(shadow).end()
            over = at == n and not closed
            if self._open == "\n" and at and (at < n or over):
                at -= 1  # the last white space before other characters stands apart
            self._push(text[:at], out)
            if over:
                return text[at:]
            self._flush(out)
        while at < n:
            end = _PRE.match(shadow, at).end()
            if closed or end + 2 <= n:
                piece = text[at:end]
                if end - at < LONG:
                    out += bpe.word(piece)
                else:
                    self._push(piece, out)
                    self._flush(out)
                at = end
            elif end == n and n - at >= LONG:
                self._open = _kind(shadow[-1])
                keep = n - (self._open == "\n")
                self._push(text[at:keep], out)
                return text[keep:]
            else:
                return text[at:]
        return ""

    def _push(self, piece: str, out: list[int]) -> None:
        """More of an unfinished pre-token: ids that end ``lookahead`` bytes before its present end are stable."""
        data, bpe = piece.encode(), self.bpe
        for i in range(0, len(data), bpe.window):
            self._bytes += data[i : i + bpe.window]
            if len(self._bytes) < bpe.window:
                continue
            at, stable = 0, len(self._bytes) - bpe.lookahead
            for token in bpe.merge(self._bytes):
                if at + bpe.size[token] > stable:
                    break
                out.append(token)
                at += bpe.size[token]
            self._bytes = self._bytes[at:]

    def _flush(self, out: list[int]) -> None:
        out += self.bpe.merge(self._bytes)
        self._open, self._bytes = None, b""


class Decoder:
    """``feed`` takes ids and gives the characters that are complete; ``end`` gives U+FFFD for a character that never was."""

    def __init__(self, bpe: StreamBpe):
        self._pieces, self._state = bpe.pieces, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        return self._state.decode(b"".join(map(self._pieces.get, ids, repeat(b""))))

    def end(self) -> str:
        return self._state.decode(b"", True)


_models: dict[str, StreamBpe] = {}


def model(path: str) -> StreamBpe:
    if path not in _models:
        _models[path] = StreamBpe(path)
    return _models[path]


def _sums(own: StreamBpe, ids: np.ndarray, decimals: np.ndarray) -> tuple[str, str]:
    """SHA-256 of the ids as decimal numbers between commas, and of the text that they decode to."""
    a, b, back = hashlib.sha256(), hashlib.sha256(), Decoder(own)
    for i in range(0, len(ids), FEED):
        part = ids[i : i + FEED]
        said = decimals[part].tobytes().translate(None, b"\0")  # without the padding of the shorter ones
        a.update(said if i else said[1:])
        b.update(back.feed(part.tolist()).encode())
    b.update(back.end().encode())
    return a.hexdigest(), b.hexdigest()


def _encode(batches, path: str, digest: bool):
    import pyarrow as pa

    own = model(path)
    decimals = np.array([b",%d" % i for i in range(max(own.pieces, default=0) + 1)])
    for batch in batches:
        for a, b, texts in slices(batch.column(1)):
            some = own.encode(texts)
            n = pa.array([len(x) for x in some], pa.int64())
            if digest:
                sums = [_sums(own, x, decimals) for x in some]
                cols, names = [pa.array([s[k] for s in sums], pa.string()) for k in (0, 1)], ["ids_sha256", "decoded_sha256"]
            else:
                cols, names = [pa.array([x.astype(np.int32) for x in some], pa.list_(pa.int32()))], ["ids"]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), n, *cols], names=["doc_id", "n_tokens", *names])


def encode(docs: DataFrame, path: str, *, digest: bool = False) -> DataFrame:
    """doc_id, n_tokens and the ids of every whole text, or with ``digest`` the SHA-256 of the ids and of the text they decode to."""
    ensure_importable(docs.sparkSession)
    ready = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return ready.mapInArrow(partial(_encode, path=path, digest=digest), SCHEMA if digest else "doc_id long, n_tokens long, ids array<int>")


def _decode(batches, path: str):
    import pyarrow as pa

    own = model(path)
    for batch in batches:
        texts = []
        for x in batch.column(1):
            if not x.is_valid:
                texts.append(None)
                continue
            back = Decoder(own)
            texts.append("".join([*(back.feed(x.values[i : i + FEED].to_pylist()) for i in range(0, len(x.values), FEED)), back.end()]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])


def decode(ids: DataFrame, path: str) -> DataFrame:
    """doc_id and the text that ``ids`` (doc_id, ids array<int>) stand for."""
    ensure_importable(ids.sparkSession)
    return ids.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(partial(_decode, path=path), "doc_id long, text string")
