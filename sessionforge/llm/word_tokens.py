"""Token ids of a ``tokenizers`` file with word ends, computed word by word.

White space never lies inside a token of such a vocabulary, so a text's ids are the ids of its chunks between
spaces, one after the other. Chunks of plain Latin letters, digits and ASCII signs take a short path through the
file's own BPE model; all others, and those that hold the name of a special token, go through the whole tokenizer.
"""

from __future__ import annotations

import numpy as np

from .common import coded, spread


def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies show for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = [""] * 256
    for b in plain:
        out[b] = chr(b)
    spare = 256
    for b in range(256):
        if not out[b]:
            out[b] = chr(spare)
            spare += 1
    return out


_SIGNS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())


class WordTokens:
    def __init__(self, path: str, limit: int = 200_000):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        if hasattr(self.model, "_resize_cache"):  # its own cache only costs time beside ours
            self.model._resize_cache(0)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self._plain = regex.compile("[ \n!-~À-įı-ɏ]*").fullmatch
        self._words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        self._letters = byte_letters()
        self._limit, self._known = limit, {"": b""}

    def _names_special(self, text: str) -> bool:
        return any(name in text for name in self._special)

    def _lowered(self, text: str) -> str:
        """In lower case where that changes no ids: names of special tokens count only as they are written."""
        low = text.lower()
        return text if self._names_special(low) else low

    def _word(self, word: str) -> bytes:
        if not word.isascii():
            word = "".join(map(self._letters.__getitem__, word.encode()))
        return np.array([t.id for t in self.model.tokenize(word)], self.dtype).tobytes()

    def _keep(self, chunk: str, ids: bytes) -> bytes:
        if len(self._known) < self._limit:
            self._known[chunk] = ids
        return ids

    def _chunk(self, chunk: str) -> bytes:
        known = self._known
        if self._names_special(chunk):
            return self._keep(chunk, np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, self.dtype).tobytes())
        head = chunk.rstrip(_SIGNS)  # signs after a word are a token run of their own
        if head.isalpha() and self._plain(head) and head == head.lower():
            tail = chunk[len(head) :]
            first, second = known.get(head), known.get(tail)
            return (self._keep(head, self._word(head)) if first is None else first) + (self._keep(tail, self._word(tail)) if second is None else second)
        if not self._plain(chunk):
            return self._keep(chunk, np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, self.dtype).tobytes())
        out = []
        for w in self._words(chunk.lower()):
            ids = known.get(w)
            out.append(self._keep(w, self._word(w)) if ids is None else ids)
        return b"".join(out)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        ready = [(self._lowered(t) if t.isascii() or self._plain(t) else t).replace("\n", " ") for t in texts]
        codes, bounds, words = coded(ready, " ")
        known, chunk = self._known, self._chunk
        ids = [chunk(w) if x is None else x for w, x in zip(words, map(known.get, words), strict=True)]
        flat, ends = spread(codes, ids, self.dtype)
        cuts = np.concatenate(([0], ends))[bounds]
        return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
