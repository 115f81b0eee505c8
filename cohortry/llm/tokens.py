"""Token ids of whole texts by a public tokenizer, with a table of words already met.

The ids are those of ``Tokenizer.encode(text, add_special_tokens=False)``. The vocabulary
drops white space and never joins characters across it, so a text's ids are its words' ids
in a row. A slice's distinct words that are new are taken first: those of plain letters and marks are
merged side by side in numpy, by the vocabulary's own merges; words with other characters go through the tokenizer
itself. The table is emptied when full, so memory is bounded.
"""

from __future__ import annotations

import json
import re
import struct

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from cohortry.llm.byte_bpe import SHORT, PairTable, merge_rows

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
CACHED_WORDS = 400_000
LONGEST_CACHED = 256
# Words are looked up for about so many bytes of text at a time, and merged in so many rows.
AT_ONCE = 1 << 22
ROWS_AT_ONCE = 20_000
# Letters that normalisation leaves alone but for their case, and marks the tokenizer keeps together.
LETTER, MARK = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(97, 123), 0xC3]] = LETTER
_KIND[[b for b in range(33, 127) if re.match(r"[!-&(-/:-@\[-`{-~]", chr(b))]] = MARK


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordIds:
    """UTF-8 words -> their ids as packed little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str = VOCABULARY, limit: int = CACHED_WORDS):
        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit
        self.known: dict[bytes, bytes] = {}
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        ids, suffix, letters = model["vocab"], model["end_of_word_suffix"], _byte_letters()
        self._inner = np.array([ids[letters[b]] for b in range(256)], np.int64)
        self._last = np.array([ids[letters[b] + suffix] for b in range(256)], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [ids[a + b] for a, b in merges]
        if made != sorted(made):
            raise ValueError("the vocabulary's ids must grow with the order of its merges")
        self._pairs = PairTable({(ids[a] << 32) | ids[b]: i for (a, b), i in zip(merges, made)})

    def _look_up(self, new: set[bytes]) -> None:
        """Merge plain words side by side; the others go through the tokenizer."""
        words = list(new)
        if not words:
            return
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = sizes.cumsum() - sizes
        data = np.frombuffer(b"".join(words), np.uint8).copy()
        data[(data >= 65) & (data <= 90)] += 32
        accent = np.append(False, data[:-1] == 0xC3)  # second bytes of the letters from À to ÿ, × and ÷
        data[accent & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 32
        kind = _KIND[data]
        kind[accent & (data >= 0x80) & (data != 0x97) & (data != 0xB7)] = LETTER
        opens = np.zeros(len(data), bool)
        opens[starts] = True
        closes = np.append(opens[1:], True)
        turned = (kind == LETTER) & ~opens & (np.append(0, kind[:-1]) == MARK)
        # A run of letters, then one of marks: each is a piece, and no merge goes beyond a piece's end.
        ends = closes | ((kind == LETTER) & (np.append(kind[1:], 0) == MARK))
        plain = (sizes <= SHORT) & (np.minimum.reduceat(kind, starts) > 0) & ~np.logical_or.reduceat(turned, starts)
        first = np.where(ends, self._last[data], self._inner[data])
        width = 2
        while width <= SHORT:
            chosen = np.flatnonzero(plain & (sizes <= width) & (sizes > (width // 2 if width > 2 else 0)))
            for some in np.split(chosen, range(ROWS_AT_ONCE, len(chosen), ROWS_AT_ONCE)):
                if len(some):
                    rows = first[np.minimum(starts[some, None] + np.arange(width), len(data) - 1)]
                    self.known.update(zip((words[i] for i in some.tolist()), merge_rows(rows, sizes[some], self._pairs)))
            width *= 2
        for i in np.flatnonzero(~plain).tolist():
            text = words[i].decode("utf-8", "replace")
            self.known[words[i]] = self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids_of(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text; a null text has none."""
        out: list[bytes] = []
        waiting: list[list[bytes]] = []
        size = 0
        for text in texts:
            data = (text or "").encode("utf-8", "replace")
            waiting.append(data.split())
            size += len(data)
            if size >= AT_ONCE:
                out += self._flush(waiting)
                waiting, size = [], 0
        return out + self._flush(waiting)

    def _flush(self, waiting: list[list[bytes]]) -> list[bytes]:
        if len(self.known) >= self.limit:
            self.known.clear()
        new = set().union(*waiting) - self.known.keys()
        self._look_up(new)
        found = [b"".join(map(self.known.__getitem__, words)) for words in waiting]
        for word in new:
            if len(word) > LONGEST_CACHED:
                del self.known[word]
        return found

    def ids(self, text: str | None) -> bytes:
        return self.ids_of([text])[0]


_loaded: dict[str, WordIds] = {}


def word_ids(path: str = VOCABULARY) -> WordIds:
    """One cache per Python worker and vocabulary."""
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]
