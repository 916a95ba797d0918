"""Token ids of whole texts, with the ids of recurring chunks remembered.

The tokenizer drops white space and never joins across it, so a text is cut at spaces and line ends, each distinct
chunk is encoded once, and the ids of a text are the ids of its chunks in a row: the same ids, several times faster.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array

import numpy as np

# Chunks in a generation. A worker remembers two: when the young one is full it becomes the old one, whose chunks
# move to the next young one as they are met again, and those not met for a generation are forgotten.
REMEMBERED = 400_000

# A chunk of Latin letters and a run of ASCII marks without apostrophe: two pre-tokens that only need lower case.
PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([!-&(-/:-@\\[-`{-~]*)")

_open: dict[str, "ChunkTokenizer"] = {}


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level tokenizers write for bytes: printable ones stand for themselves, the others
    follow from code point 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class ChunkTokenizer:
    """For byte-level tokenizers that lower the case and split at white space first (``word_bpe_49k.json``)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def _whole(self, chunk: str) -> bytes:
        return array(self.code, self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """Plain chunks go to the model's merges directly, all others through the whole tokenizer."""
        plain = PLAIN.fullmatch(chunk)
        if plain is None or not (chunk.isascii() or unicodedata.is_normalized("NFC", chunk)):
            return self._whole(chunk)
        word, marks = plain.groups()
        word = word.lower()
        if marks and word in self.known:
            ids = self.known[word]
        else:
            letters = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            ids = array(self.code, [t.id for t in self.model.tokenize(letters)]).tobytes()
        if marks:
            if marks not in self.known:
                self.known[marks] = self._whole(marks)
            self.known.setdefault(word, ids)
            ids += self.known[marks]
        return ids

    def _learn(self, chunks: list[str]) -> None:
        """Ids of chunks not known yet; words come before the chunks that add marks to them."""
        known, code, tokenize, letters = self.known, self.code, self.model.tokenize, self.letters
        for chunk in sorted(chunks, key=len):
            if chunk.isascii() and chunk.isalpha():
                word = chunk.lower()
                ids = known.get(word)
                if ids is None:
                    ids = known[word] = array(code, [t.id for t in tokenize(word)]).tobytes()
                known[chunk] = ids
            else:
                known[chunk] = self._chunk(chunk)

    def encode(self, texts: list[str | None], end: int | None = None) -> list[np.ndarray]:
        """Ids of each text (null: empty), then the id ``end``."""
        chunks = [(t or "").replace("\n", " ").split(" ") for t in texts]
        distinct = set().union(*chunks)
        new = distinct - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.known, self.old, new = {"": b""}, self.known, distinct
        again = new & self.old.keys()
        self.known.update((c, self.old[c]) for c in again)
        self._learn(list(new - again))
        tail = b"" if end is None else np.array([end], self.dtype).tobytes()
        of = self.known.__getitem__
        return [np.frombuffer(b"".join(map(of, own)) + tail, self.dtype) for own in chunks]


def tokenizer(path: str) -> ChunkTokenizer:
    """One per worker process."""
    if path not in _open:
        _open[path] = ChunkTokenizer(path)
    return _open[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
