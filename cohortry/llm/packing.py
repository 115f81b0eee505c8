"""Best-fit packing of documents into sequences, after a dominance reduction.

A document is its token ids and a closing id. Longer ones are cut at the capacity. Pieces
of equal length are interchangeable, so packing works on the number of pieces per length,
a table of at most ``capacity`` rows. Martello and Toth's reduction first fixes, for a
length, a set of at most three pieces that no other set with that length can beat; the
rest is packed best fit, longest first. Both work on whole runs of equal pieces, so the
plan's size depends on the capacity and not on the corpus. Every piece finds its place by
its rank among the pieces of its length; ranks come from hashed shares of each length, so
a length held by a third of all pieces spreads over all shares.

Defined results: null and empty texts are the closing id alone; documents that repeat a
doc_id are packed like any other; an empty table gives an empty one; a null doc_id stays
null; other columns don't matter.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortry.llm.common import map_batches, split_key, type_of
from cohortry.llm.tokens import VOCABULARY, word_ids
from cohortry.sources.scratch import stored

CAPACITY = 2048
CLOSING = (0).to_bytes(4, "little")
ROWS_PER_SHARE = 250_000
LEAST_SHARES = 256


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""

    def cut(batch: pa.RecordBatch) -> dict[str, object]:
        words = word_ids(vocabulary)
        row, piece, start, length, crc = [], [], [], [], []
        for i, ids in enumerate(words.ids_of(batch.column("text").to_pylist())):
            ids += CLOSING
            for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                row.append(i)
                piece.append(k)
                start.append(at // 4)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
        return {
            "doc_id": batch.column("doc_id").take(pa.array(row, pa.int64())),
            "piece": pa.array(piece, pa.int32()),
            "start": pa.array(start, pa.int64()),
            "length": pa.array(length, pa.int64()),
            "ids_crc32": pa.array(crc, pa.int64()),
        }

    kind = type_of(docs, "doc_id")
    return map_batches(
        docs.select("doc_id", "text"), cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


class Stock:
    """How many pieces of each length are left, with the lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {w: n for w, n in counts.items() if n > 0}
        self.lengths = sorted(self.counts)

    def take(self, chosen: tuple[int, ...], times: int) -> None:
        for w in chosen:
            self.counts[w] -= times
        for w in set(chosen):
            if not self.counts[w]:
                del self.counts[w]
                del self.lengths[bisect_left(self.lengths, w)]

    def often(self, chosen: tuple[int, ...]) -> int:
        """How many times the set can be taken."""
        return min(self.counts.get(w, 0) // chosen.count(w) for w in set(chosen))

    def smallest(self, without: tuple[int, ...], above: int = 0, many: int = 3) -> list[int]:
        """The smallest pieces longer than ``above`` when ``without`` is out."""
        found: list[int] = []
        for w in self.lengths[bisect_left(self.lengths, above + 1) :]:
            found += [w] * min(many - len(found), self.counts[w] - without.count(w))
            if len(found) == many:
                break
        return found

    def largest(self, room: int, without: tuple[int, ...]) -> int | None:
        """The longest piece that fits when ``without`` is out."""
        for i in range(bisect_left(self.lengths, room + 1) - 1, -1, -1):
            if self.counts[self.lengths[i]] > without.count(self.lengths[i]):
                return self.lengths[i]
        return None


def _best_pair(stock: Stock, w: int, room: int) -> tuple[int, int] | None:
    """Two more pieces beside one of length ``w`` that fill the room best."""
    best: tuple[int, int] | None = None
    for a in reversed(stock.lengths):
        if a >= room or stock.counts[a] <= (a == w):
            continue
        if best and 2 * a < sum(best):
            break
        b = stock.largest(min(room - a, a), (w, a))
        if b is not None and (best is None or a + b > sum(best)):
            best = (a, b)
    return best


def dominating(stock: Stock, w: int, capacity: int) -> tuple[int, ...] | None:
    """A set with one piece of length ``w`` that no feasible set with it can beat, or None."""
    room = capacity - w
    small = stock.smallest((w,))
    if not small or small[0] > room:
        return (w,)
    top = stock.largest(room, (w,))
    if top == room or len(small) < 2 or small[0] + small[1] > room:
        return (w, top)
    if len(small) < 3 or sum(small) > room:  # at most two more fit
        a, b = _best_pair(stock, w, room)
        if top >= a + b:
            return (w, top)
        # Every other pair is smaller piece by piece unless two longer than b fit without a.
        between = stock.smallest((w, a), above=b, many=2)
        if a == top and (len(between) < 2 or sum(between) > room):
            return (w, a, b)
    return None


def reduce_stock(stock: Stock, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fix dominating sets, longest pieces first, until none is left; returns (set, times)."""
    fixed, changed = [], True
    while changed:
        changed = False
        for w in reversed(stock.lengths.copy()):
            while stock.counts.get(w) and (chosen := dominating(stock, w, capacity)):
                # What makes a set dominate stays true as pieces go, so it is taken as often as it can.
                times = stock.often(chosen)
                stock.take(chosen, times)
                fixed.append((chosen, times))
                changed = True
    return fixed


def best_fit(stock: Stock, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, over runs of equal pieces; returns (set, times)."""
    by_room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(room: int, chosen: tuple[int, ...], times: int) -> None:
        if times:
            if room not in by_room:
                rooms.insert(bisect_left(rooms, room), room)
                by_room[room] = []
            by_room[room].append((chosen, times))

    for w in reversed(stock.lengths):
        n = stock.counts[w]
        while n and (i := bisect_left(rooms, w)) < len(rooms):
            room = rooms[i]
            chosen, times = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[i]
            used = min(n, times)
            put(room, chosen, times - used)
            put(room - w, (*chosen, w), used)
            n -= used
        each = capacity // w
        put(capacity - each * w, (w,) * each, n // each)
        if n % each:
            put(capacity - n % each * w, (w,) * (n % each), 1)
    return [entry for room in rooms for entry in by_room[room]]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths in order, how many such sequences)."""
    stock = Stock(counts)
    return reduce_stock(stock, capacity) + best_fit(stock, capacity)


def _places(sequences: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length rows (first rank, first sequence, offset), by rank."""
    places: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    base = 0
    for lengths, times in sequences:
        offset = 0
        for w in lengths:
            first = ranks.get(w, 0)
            places.setdefault(w, []).append((first, base, offset))
            ranks[w] = first + times
            offset += w
        base += times
    return {w: np.array(rows, np.int64) for w, rows in places.items()}


def pack_pieces(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to a stored table of pieces."""
    n = cut.count()
    shares = max(LEAST_SHARES, -(-n // ROWS_PER_SHARE) * 4)
    names = cut.columns
    shared = cut.withColumn("__share", split_key(shares, "doc_id", "piece", "ids_crc32"))
    totals = stored(shared.groupBy("length", "__share").agg(F.count(F.lit(1)).alias("__n")), "pack-counts")
    counts = {int(r["length"]): int(r["n"]) for r in totals.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    earlier = Window.partitionBy("length").orderBy("__share").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("length", "__share", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("length", "__share").orderBy("doc_id", "piece", "ids_crc32")
    ranked = shared.withColumn("__row", F.row_number().over(inside)).join(starts, ["length", "__share"])
    ranked = ranked.select(*names, (F.col("__before") + F.col("__row") - 1).alias("__rank"))
    places = cut.sparkSession.sparkContext.broadcast(_places(plan(counts, capacity)))

    def assign(batch: pa.RecordBatch) -> dict[str, object]:
        lengths = batch.column("length").to_numpy(zero_copy_only=False)
        rank = batch.column("__rank").to_numpy(zero_copy_only=False)
        sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
        for w in np.unique(lengths):
            mine, slots = np.flatnonzero(lengths == w), places.value[int(w)]
            at = slots[np.searchsorted(slots[:, 0], rank[mine], side="right") - 1]
            sequence[mine] = at[:, 1] + rank[mine] - at[:, 0]
            offset[mine] = at[:, 2]
        kept = {name: batch.column(name) for name in names}
        return kept | {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    return map_batches(ranked, assign, f"{schema}, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack_pieces(stored(pieces(docs, capacity, vocabulary), "pack-pieces"), capacity)
