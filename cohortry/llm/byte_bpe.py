"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

A text is cut into pieces by the tokenizer's pattern and each piece is encoded by itself. A
piece that is a token needs no merge. In any other a segment tree over its byte positions
holds, per live position, the rank of the pair that starts there, and per inner node the
leftmost minimum of its half. The root is the next merge. A merge changes three leaves (the
merged position, its live neighbour before it, and the one swallowed), so it costs a
logarithm of the piece's length, and a piece of a million letters takes n log n steps.

Pieces repeat, so every Python worker keeps a bounded table of short ones it has met. Those
it has not met yet are merged together: their ranks are the columns of one matrix, whose
least values are found in one pass, and every step merges once in each piece. Long texts are cut where a piece must begin anyway (before a
single blank between two characters that aren't white space), so that pieces in memory are
bounded, while a text's ids are whole.

Defined results: null and empty texts have no ids and decode to no bytes; repeated rows
give repeated rows; a null doc_id stays null; an empty table gives an empty one; other
columns don't matter. Ids outside the vocabulary raise an error when decoded.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cohortry.llm.common import map_batches, type_of

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
CACHED_PIECES = 300_000
# Pieces up to this many bytes are merged side by side and remembered; longer ones one by one.
SHORT = 64
# Long texts are cut into segments of about this many characters while pieces are found, and
# pieces of about so many characters are looked up at once.
SEGMENT = 1 << 16
AT_ONCE = 1 << 20
_NEVER = 1 << 62
# An odd number near 2^64 over the golden ratio: products spread neighbouring codes over all slots.
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_CUT = regex.compile(r"(?<=\S) (?=\S)")


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: the leftmost pair of least rank is merged until no pair has a rank.

    A leaf's key is rank * size + position, so that the least key is the leftmost least rank;
    ``tree[1]`` is the root and the children of node i are 2i and 2i + 1.
    """
    n, find = len(piece), ranks.get
    size = 1 << max(0, n - 2).bit_length()
    tree = [_NEVER] * (2 * size)
    for i in range(n - 1):
        if (rank := find(piece[i : i + 2])) is not None:
            tree[size + i] = rank * size + i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    after, before = list(range(1, n + 2)), list(range(-1, n))  # live neighbours; n is the end
    while (least := tree[1]) != _NEVER:
        i = least & (size - 1)
        j = after[i]
        k = after[i] = after[j]
        before[k] = i
        changed = []
        if j < n - 1:  # the position swallowed
            changed.append((j, None))
        changed.append((i, find(piece[i : after[k]]) if k < n else None))
        if i:
            changed.append((before[i], find(piece[before[i] : k])))
        for position, rank in changed:
            node = size + position
            key = tree[node] = _NEVER if rank is None else rank * size + position
            while node > 1:
                other = tree[node ^ 1]
                if other < key:
                    key = other
                node >>= 1
                if tree[node] == key:
                    break
                tree[node] = key
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """The text in parts that no piece crosses."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class PairTable:
    """Pairs of token ids and the ids that they merge into; the least id merges first.

    A pair is found from the slot that its code hashes to, or one of the next few.
    """

    def __init__(self, codes: dict[int, int]):
        given = np.fromiter(codes.keys(), np.int64, len(codes))
        bits = max(4, (4 * len(codes)).bit_length())
        self._shift = np.uint64(64 - bits)
        self.codes = np.full(1 << bits, -1, np.int64)
        self.made = np.full(1 << bits, -1, np.int64)
        at = self._slots(given)
        waiting = np.arange(len(given))
        while len(waiting):
            free = waiting[self.codes[at[waiting]] < 0]
            taken, first = np.unique(at[free], return_index=True)  # one pair per free slot
            self.codes[taken] = given[free[first]]
            waiting = waiting[self.codes[at[waiting]] != given[waiting]]
            at[waiting] = (at[waiting] + 1) & (len(self.codes) - 1)
        kept = self.codes >= 0
        self.made[kept] = [codes[c] for c in self.codes[kept].tolist()]

    def _slots(self, code: np.ndarray) -> np.ndarray:
        return ((code.astype(np.uint64) * _SPREAD) >> self._shift).astype(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that each pair makes, or -1."""
        code = (left << 32) | right
        at = self._slots(code)
        met = self.codes[at]
        out = np.where(met == code, self.made[at], -1)
        others = np.flatnonzero((met != code) & (met >= 0))
        while len(others):
            at[others] = (at[others] + 1) & (len(self.codes) - 1)
            met = self.codes[at[others]]
            found = met == code[others]
            out[others[found]] = self.made[at[others[found]]]
            others = others[~found & (met >= 0)]
        return out


def merge_rows(ids: np.ndarray, sizes: np.ndarray, pairs: PairTable) -> list[bytes]:
    """Packed ids of pieces given as rows of first ids, of which ``sizes`` count: row by row what ``merge`` does to one.

    Rows are as wide as a power of two of 2 at least; ids are merged in place. Each row's least pair is the least of its
    column of keys, (rank, place) in one number, so one pass over the keys finds those of all rows.
    """
    rows, width = ids.shape
    levels, place = width.bit_length() - 1, np.arange(width)
    live = place < sizes[:, None]
    rank = pairs.of(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(rows, width - 1)
    rank[place[1:] >= sizes[:, None]] = -1
    keys = np.full((width, rows), _NEVER, np.int64)
    keys[:-1] = np.where(rank < 0, _NEVER, rank * width + place[:-1]).T
    after = np.tile(np.arange(1, width + 2), (rows, 1))
    before = np.tile(np.arange(-1, width), (rows, 1))
    held = np.arange(rows)  # the row of each column of keys
    while True:
        least = keys.min(axis=0)
        on = np.flatnonzero(least != _NEVER)
        if not len(on):
            break
        least = least[on]
        if 2 * len(on) <= len(held):  # rows that are done leave
            keys, held, on = keys[:, on], held[on], np.arange(len(on))
        active = held[on]
        i = least & (width - 1)
        j = after[active, i]
        k = after[active, j]
        h = before[active, i]
        after[active, i], before[active, k] = k, i
        ids[active, i] = made = least >> levels
        live[active, j] = False
        inner, first = k < sizes[active], h >= 0
        right = np.where(inner, pairs.of(made, ids[active, np.minimum(k, width - 1)]), -1)
        left = np.where(first, pairs.of(ids[active, np.maximum(h, 0)], made), -1)
        keys[j, on] = _NEVER
        keys[i, on] = np.where(right < 0, _NEVER, right * width + i)
        on, h, left = on[first], h[first], left[first]
        keys[h, on] = np.where(left < 0, _NEVER, left * width + h)
    packed = ids[live].astype("<u4").tobytes()
    ends = (4 * live.sum(axis=1).cumsum()).tolist()
    return [packed[a:b] for a, b in zip([0, *ends], ends)]


def as_rows(pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of pieces as rows of that width, and their sizes."""
    data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(len(pieces), width)
    return data, np.array([len(p) for p in pieces])


class Vocabulary:
    """Ranks of tokens, which are their ids, and pairs of tokens that make one."""

    def __init__(self, path: str = VOCABULARY):
        self.ranks = ranks = read_ranks(path)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.pairs = PairTable({
            (ranks[token[:cut]] << 32) | ranks[token[cut:]]: rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        })

    def merge_rows(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Packed ids of pieces of 2 to ``width`` bytes, a power of two."""
        data, sizes = as_rows(pieces, width)
        return merge_rows(self.byte_ids[data], sizes, self.pairs)

    def encode_pieces(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """Packed ids of pieces."""
        out: dict[str, bytes] = {}
        by_width: dict[int, list[str]] = {}
        for piece in pieces:
            data = piece.encode()
            if (whole := self.ranks.get(data)) is not None:
                out[piece] = whole.to_bytes(4, "little")
            elif len(data) <= SHORT:
                by_width.setdefault(1 << (len(data) - 1).bit_length(), []).append(piece)
            else:
                out[piece] = np.array(merge(data, self.ranks), "<u4").tobytes()
        for width, some in by_width.items():
            out.update(zip(some, self.merge_rows([p.encode() for p in some], width)))
        return out


class Codec:
    """Texts to packed little-endian unsigned 32-bit ids and back; remembers up to ``limit`` short pieces."""

    def __init__(self, path: str = VOCABULARY, pattern: str = PATTERN, limit: int = CACHED_PIECES):
        self.vocabulary = Vocabulary(path)
        self.find = regex.compile(pattern).findall
        self.limit = limit
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        chars = 0
        for row, text in enumerate(texts):
            for part in segments(text or ""):
                waiting.append((row, self.find(part)))
                chars += len(part)
                if chars >= AT_ONCE:
                    self._look_up(waiting, out)
                    waiting, chars = [], 0
        self._look_up(waiting, out)
        return [b"".join(parts) for parts in out]

    def _look_up(self, waiting: list[tuple[int, list[str]]], out: list[list[bytes]]) -> None:
        if len(self.known) > self.limit:
            self.known.clear()
        new = set().union(*(pieces for _, pieces in waiting)) - self.known.keys()
        self.known.update(self.vocabulary.encode_pieces(new))
        for row, pieces in waiting:
            out[row].append(b"".join(map(self.known.__getitem__, pieces)))
        for piece in new:
            if len(piece) > SHORT:
                del self.known[piece]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@cache
def codec(path: str, pattern: str) -> Codec:
    """One table per Python worker and vocabulary."""
    return Codec(path, pattern)


def encode_texts(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """doc_id, ids of every row: ids as little-endian unsigned 32-bit numbers in one binary value."""

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        ids = codec(vocabulary, pattern).encode(batch.column("text").to_pylist())
        return {"doc_id": batch.column("doc_id"), "ids": pa.array(ids, pa.binary())}

    return map_batches(docs.select("doc_id", "text"), work, f"doc_id {type_of(docs, 'doc_id')}, ids binary")


def decode_ids(encoded: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """``doc_id, ids`` with the bytes they stand for in ``decoded``."""

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        decode, ids = codec(vocabulary, pattern).decode, batch.column("ids")
        texts = [decode(x or b"") for x in ids.to_pylist()]
        return {"doc_id": batch.column("doc_id"), "ids": ids, "decoded": pa.array(texts, pa.binary())}

    return map_batches(encoded.select("doc_id", "ids"), work, f"doc_id {type_of(encoded, 'doc_id')}, ids binary, decoded binary")
