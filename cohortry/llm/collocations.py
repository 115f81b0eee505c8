"""Phrase collocations by the stripes pattern.

A stripe is a prefix of words with an associative counter of the words that come next. Each
task counts its own stripes and merges them as it reads; stripes then meet by prefix and
are merged elementwise. One structure gives all that is needed: a counter's entry is the
number of occurrences of prefix and next word, its sum (an entry for "nothing that
matters comes next" included) the number of the prefix, and the greatest entries are what
may subsume a phrase.

Stripes are counted by length of prefix: none (words), one, then three, whose sums are the
counts of three words and whose entries those of four. What cannot be part of a candidate
is left out between the steps by a Bloom filter of the words, then pairs of words, that are
frequent enough: a phrase is never more frequent than its parts. The filters' size is
bounded, they only ever let too much pass, and results don't depend on them.

The stripe of a heavy word (one in ``HEAVY`` of all words at least, so at most ``HEAVY``
words) is cut into segments by the next word's hash, so that a word holding a third of all
words spreads over many tasks. No counter is ever held whole by a task.

Words travel as 64-bit hashes of language and word, taken from numpy arrays of the texts'
bytes; two words under one hash are detected, and everything is counted again by another seed.

Defined results: null and empty texts have no words; a null language is ``und`` (and counts
with texts that say so); repeated rows count as often as they occur; ties are ordered by
score, count and phrase; an empty table gives an empty one; other columns don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.llm.common import importable, split_key
from cohortry.sources.scratch import stored

LEAST = 30
LONGEST = 4
TOP = 2_000
# A candidate goes when a longer phrase that contains it is at least so frequent, in percent.
SUBSUMED = 80
SCALE = 2_000_000
UNKNOWN = "und"
HEAVY = 1_000
SEGMENTS = 256
ROWS_PER_MERGE = 2_000_000
# Bits of a filter per entry, at most, and probes.
FILTER_BITS = 16
MAX_FILTER_BITS = 1 << 27
PROBES = 4
# Bytes of text, and entries of counters, that a task looks at at a time.
CHUNK = 1 << 21
HELD = 1_500_000
SHORT_WORD = 48
SEEDS = 8

_SEPARATOR = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")
_BREAKS = np.frombuffer(b".,;:!?\x0a\x0b\x0c\x0d", np.uint8)
_KIND = np.ones(256, np.uint8)  # 1 inside a word, 0 between words, 2 between pieces
_KIND[np.frombuffer(b" \t", np.uint8)] = 0
_KIND[_BREAKS] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def joint(columns: list[np.ndarray]) -> np.ndarray:
    """One hash of several columns of hashes."""
    out = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        out = mixed(out * _GOLD + column.view(np.uint64))
    return out


class Words:
    """The words of some texts of one language: hash per place, and 0 where a piece ends."""

    def __init__(self, blob: bytes, language: str, seed: int):
        self.data = _LOWER[np.frombuffer(blob, np.uint8)]
        self.starts, self.ends, hashes, at = [], [], [], 0
        salt = np.uint64(xxhash.xxh3_64_intdigest(language.encode(), seed=seed))
        weights = np.random.RandomState(seed + 1).randint(1, 1 << 62, SHORT_WORD).astype(np.uint64) * np.uint64(4) + np.uint64(1)
        while at < len(blob):
            cut = _SEPARATOR.search(blob, at + CHUNK)
            end = cut.end() if cut else len(blob)
            hashes.append(self._chunk(at, end, salt, weights, seed))
            at = end
        self.hashes = np.concatenate([*hashes, np.zeros(1, np.uint64)]).view(np.int64)
        self.starts, self.ends = (np.concatenate([*x, np.zeros(1, np.int64)]) for x in (self.starts, self.ends))

    def _chunk(self, at: int, end: int, salt: np.uint64, weights: np.ndarray, seed: int) -> np.ndarray:
        data = self.data[at:end]
        kind = _KIND[data]
        inside = kind == 1
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        breaks = np.flatnonzero(kind == 2)
        where = np.searchsorted(starts, breaks)  # a break belongs before the first word that starts after it
        if not len(starts):
            hashes = np.empty(0, np.uint64)
        else:
            sizes = ends - starts
            offsets = np.arange(len(data))[inside] - np.repeat(starts, sizes)
            value = (data[inside].astype(np.uint64) + np.uint64(1)) * weights[np.minimum(offsets, SHORT_WORD - 1)]
            hashes = np.add.reduceat(value, np.concatenate([[0], sizes.cumsum()[:-1]]))
            for i in np.flatnonzero(sizes > SHORT_WORD):
                hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes(), seed=seed)
            hashes = mixed(mixed(hashes + sizes.astype(np.uint64) * _GOLD) ^ salt)
            hashes[hashes == 0] = 1
        where = np.unique(where)
        self.starts.append(np.insert(starts + at, where, -1))
        self.ends.append(np.insert(ends + at, where, -1))
        return np.insert(hashes, where, 0)

    def spelled(self, places: np.ndarray) -> list[str]:
        text = self.data.tobytes()
        return [text[a:b].decode() for a, b in zip(self.starts[places].tolist(), self.ends[places].tolist())]


def _runs(columns: list[np.ndarray]) -> np.ndarray:
    """Where rows of sorted columns differ from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def merge_counts(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows as one, in order, with the sums of their counts."""
    if not len(counts):
        return columns, counts
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    first = _runs(columns)
    return [c[first] for c in columns], np.add.reduceat(counts[order], first)


class Filter:
    """Bloom filter over hashes."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def has(self, hashes: np.ndarray) -> np.ndarray:
        h = mixed(hashes.view(np.uint64))
        step = mixed(h + _GOLD) | np.uint64(1)
        out = np.ones(len(h), bool)
        for _ in range(PROBES):
            place = (h & np.uint64(self.bits - 1)).astype(np.int64)
            out &= (self.words[place >> 6] >> (place & 63)) & 1 == 1
            h = h + step
        return out


def _probes(batch: np.ndarray, bits: int) -> np.ndarray:
    h = mixed(batch.view(np.uint64))
    step = mixed(h + _GOLD) | np.uint64(1)
    return np.concatenate([((h + np.uint64(i) * step) & np.uint64(bits - 1)).astype(np.int64) for i in range(PROBES)])


def bloom_filter(hashes: DataFrame) -> Filter:
    """A filter of the bigint column ``h``; at most ``MAX_FILTER_BITS`` large whatever the table's size."""
    bits = min(MAX_FILTER_BITS, max(1 << 10, 1 << (hashes.count() * FILTER_BITS - 1).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = _probes(batch.column("h").to_numpy(zero_copy_only=False), bits)
            word, bit = place >> 6, np.int64(1) << (place & 63)
            order = np.argsort(word, kind="stable")
            first = _runs([word[order]])
            merged = np.bitwise_or.reduceat(bit[order], first) if len(first) else bit
            yield pa.RecordBatch.from_arrays([pa.array(word[order][first]), pa.array(merged)], names=["word", "bits"])

    importable(hashes.sparkSession)
    rows = hashes.mapInArrow(places, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(bits >> 6, np.int64)
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return Filter(words, bits)


Count = Callable[[Words], tuple[list[np.ndarray], np.ndarray]]


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """Language and joined texts, some megabytes at a time."""
    texts, languages = batch.column("text"), batch.column("lang").to_pylist()
    groups: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for i, language in enumerate(languages):
        text = texts[i].as_py()
        if text:
            groups.setdefault(language, []).append(text.encode())
            sizes[language] = sizes.get(language, 0) + len(text)
            if sizes[language] >= 2 * CHUNK:
                yield language, b"\n".join(groups.pop(language))
                del sizes[language]
    for language, parts in groups.items():
        yield language, b"\n".join(parts)


def count_words(docs: DataFrame, seed: int) -> DataFrame:
    """h, lang, word, f: the stripe of no prefix, by hash of the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str, int], int] = {}

        def flush() -> pa.RecordBatch:
            rows = list(zip(*held)) if held else [(), (), ()]
            arrays = [pa.array(rows[2], pa.int64()), pa.array(rows[0], pa.string()), pa.array(rows[1], pa.string()), pa.array(held.values(), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["h", "lang", "word", "f"])

        for batch in batches:
            for language, blob in _texts(batch):
                words = Words(blob, language, seed)
                h, place, f = np.unique(words.hashes, return_index=True, return_counts=True)
                h, place, f = h[h != 0], place[h != 0], f[h != 0]
                for key, n in zip(zip([language] * len(h), words.spelled(place), h.tolist()), f.tolist()):
                    held[key] = held.get(key, 0) + n
                if len(held) > HELD // 5:
                    yield flush()
        yield flush()

    importable(docs.sparkSession)
    rows = docs.mapInArrow(run, "h bigint, lang string, word string, f bigint")
    entry = F.struct("lang", "word")
    return rows.groupBy("h").agg(F.min(entry).alias("low"), F.max(entry).alias("high"), F.sum("f").alias("f"))


STRIPE = "prefix array<bigint>, segment int, next binary, counts binary"


def count_stripes(docs: DataFrame, seed: int, count: Count, length: int, heavy: np.ndarray) -> DataFrame:
    """Stripes of prefixes of ``length`` words, merged per task: prefix, segment, next words and their counts.

    ``count`` gives the columns prefix..., next of the occurrences that matter. A stripe all of whose
    words are heavy comes in segments.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[list[np.ndarray], np.ndarray]] = []
        size = 0

        def compact() -> None:
            nonlocal size
            columns = [np.concatenate([h[0][i] for h in held]) for i in range(length + 1)]
            held[:] = [merge_counts(columns, np.concatenate([h[1] for h in held]))]
            size = len(held[0][1])

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size
            if held:
                compact()
                yield from _stripe_batches(*held[0], heavy)
            held.clear()
            size = 0

        for batch in batches:
            for language, blob in _texts(batch):
                columns, counts = count(Words(blob, language, seed))
                held.append(merge_counts(columns, counts))
                size += len(held[-1][1])
                if size > HELD:
                    compact()
                    if size > HELD // 2:
                        yield from flush()
        yield from flush()

    importable(docs.sparkSession)
    return docs.mapInArrow(run, STRIPE)


def _stripe_batches(columns: list[np.ndarray], counts: np.ndarray, heavy: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorted entries as one row per stripe and segment."""
    *prefix, after = columns
    wide = np.ones(len(after), bool)
    for c in prefix:
        wide &= np.isin(c, heavy)
    segment = np.where(wide, (joint([after]) % np.uint64(SEGMENTS)).astype(np.int64), 0)
    order = np.lexsort([after, segment, *prefix[::-1]])
    prefix, after, segment, counts = [c[order] for c in prefix], after[order], segment[order], counts[order]
    first = _runs([*prefix, segment])
    for a in range(0, len(first), 50_000):
        some = first[a : a + 50_000]
        end = first[a + 50_000] if a + 50_000 < len(first) else len(after)
        bounds = 8 * (np.append(some, end) - some[0])
        packed = [pa.py_buffer(np.ascontiguousarray(x[some[0] : end]).tobytes()) for x in (after, counts)]
        offsets = pa.py_buffer(bounds.astype(np.int32).tobytes())
        words = np.stack([c[some] for c in prefix], axis=1).ravel()
        lists = pa.ListArray.from_arrays(np.arange(len(some) + 1, dtype=np.int32) * len(prefix), words)
        yield pa.RecordBatch.from_arrays(
            [lists, pa.array(segment[some].astype(np.int32))] + [pa.Array.from_buffers(pa.binary(), len(some), [None, offsets, x]) for x in packed],
            names=["prefix", "segment", "next", "counts"],
        )


def merge_stripes(stripes: DataFrame, length: int, least: int) -> DataFrame:
    """Merge stored stripes elementwise: words (prefix and next), f of the entries; where a prefix has three
    words also its totals (next left out), per segment. Entries below ``least`` go, totals stay.
    """
    entries = stripes.agg(F.coalesce(F.sum(F.length("next")), F.lit(0)) / 8).first()[0]
    parts = max(stripes.sparkSession.sparkContext.defaultParallelism, int(entries // ROWS_PER_MERGE) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[list[np.ndarray], np.ndarray]] = []
        size = 0

        def compact() -> None:
            nonlocal size
            columns = [np.concatenate([h[0][i] for h in held]) for i in range(length + 1)]
            held[:] = [merge_counts(columns, np.concatenate([h[1] for h in held]))]
            size = len(held[0][1])

        last = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = np.array([len(x) for x in batch.column("next").to_pylist()]) // 8
            prefix = batch.column("prefix").flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
            after, counts = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int64) for c in ("next", "counts"))
            held.append(([*(np.repeat(prefix[:, i], sizes) for i in range(length)), after], counts))
            size += len(after)
            if size > 2 * max(last, HELD):
                compact()
                last = size
        if not held:
            return
        compact()
        (*prefix, after), counts = held[0]
        first = _runs(prefix)
        totals = np.add.reduceat(counts, first) if len(first) else counts[:0]
        keep = (counts >= least) & (after != 0)
        rows = [(np.stack([*prefix, after], axis=1)[keep], counts[keep])]
        if length > 1:
            rows.append((np.stack([c[first] for c in prefix], axis=1), totals))
        for words, f in rows:
            for a in range(0, len(f), 50_000):
                some = words[a : a + 50_000]
                lists = pa.ListArray.from_arrays(np.arange(len(some) + 1, dtype=np.int32) * some.shape[1], some.ravel())
                yield pa.RecordBatch.from_arrays(
                    [lists, pa.array(f[a : a + 50_000]), pa.array(joint(list(np.ascontiguousarray(some.T))).view(np.int64))], names=["words", "f", "h"]
                )

    importable(stripes.sparkSession)
    merged = stripes.repartition(parts, "prefix", "segment").mapInArrow(run, "words array<bigint>, f bigint, h bigint")
    return stored(merged, "phrases-merged")


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(words: h, lang, word, f of all; phrases: words, f of one to four words that occur ``least`` times)."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text").where("text <> ''")
    for seed in range(SEEDS):
        words = stored(count_words(texts, seed), "phrases-words")
        if words.where("low <> high").isEmpty():
            break
    else:
        raise RuntimeError(f"words share hashes under {SEEDS} seeds")
    words = words.select("h", "low.lang", "low.word", "f")
    total = words.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    heavy = np.array([r["h"] for r in words.where(F.col("f") * HEAVY >= total).where("f > 0").select("h").collect()], np.int64)  # at most HEAVY
    often = words.where(F.col("f") >= least)
    spark = docs.sparkSession

    known = spark.sparkContext.broadcast(bloom_filter(often.select("h")))

    def pairs(words: Words) -> tuple[list[np.ndarray], np.ndarray]:
        w = words.hashes
        good = known.value.has(w) & (w != 0)
        at = np.flatnonzero(good[:-1] & good[1:])
        return [w[at], w[at + 1]], np.ones(len(at), np.int64)

    two = stored(count_stripes(texts, seed, pairs, 1, heavy), "phrases-stripes")
    two = merge_stripes(two, 1, least)
    paired = spark.sparkContext.broadcast(bloom_filter(two.select("h")))

    def windows(words: Words) -> tuple[list[np.ndarray], np.ndarray]:
        w = np.append(words.hashes, [0, 0])
        good = np.zeros(len(w), bool)  # whether a frequent pair starts here
        at = np.flatnonzero((w[:-1] != 0) & (w[1:] != 0))
        good[at] = paired.value.has(joint([w[at], w[at + 1]]).view(np.int64))
        at = np.flatnonzero(good[:-2] & good[1:-1])
        return [w[at], w[at + 1], w[at + 2], np.where(good[at + 2], w[np.minimum(at + 3, len(w) - 1)], 0)], np.ones(len(at), np.int64)

    more = stored(count_stripes(texts, seed, windows, 3, heavy), "phrases-stripes")
    more = merge_stripes(more, 3, least)
    three = more.where(F.size("words") == 3).groupBy("words").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    one = often.select(F.array("h").alias("words"), "f")
    both = two.select("words", "f").unionByName(three).unionByName(more.where(F.size("words") == LONGEST).select("words", "f"))
    return words, stored(one.unionByName(both), "phrases-frequent")


def _wide(column: Column) -> Column:
    return column.cast("decimal(38,0)")


def score_candidates(phrases: DataFrame) -> DataFrame:
    """words, a, l, r, score of the phrases of two words or more that no longer one subsumes."""
    n = F.size("words")
    candidates = phrases.where(n > 1).withColumnRenamed("f", "a")
    cuts = candidates.select("words", "a", F.explode(F.sequence(F.lit(1), n - 1)).alias("k"))
    cuts = cuts.withColumn("first", F.slice("words", F.lit(1), F.col("k"))).withColumn("rest", F.slice("words", F.col("k") + 1, n))
    for part, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(phrases.select(F.col("words").alias(part), F.col("f").alias(name)), part)
    # Whole numbers of 38 digits, as the product may pass 64 bits.
    score = F.expr(f"cast(a as decimal(38,0)) * {SCALE} div (cast(l as decimal(38,0)) + r)")
    lowest = cuts.withColumn("score", score).groupBy("words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    longer = phrases.where(n > 2)
    inner = F.flatten(F.transform(
        F.sequence(F.lit(2), n - 1), lambda m: F.transform(F.sequence(F.lit(1), n - m + 1), lambda i: F.slice("words", i, m))
    ))
    around = longer.select(F.explode(inner).alias("words"), "f").groupBy("words").agg(F.max("f").alias("most"))
    kept = lowest.join(around, "words", "left").where(
        F.col("most").isNull() | (_wide(F.col("most")) * 100 < _wide(F.col("a")) * SUBSUMED)
    )
    return kept.select("words", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases per language: lang, rank, phrase, a, l, r, n, score."""
    words, phrases = frequent_phrases(docs, least)
    scored = stored(score_candidates(phrases), "phrases-scored")
    # Only ranks of whole languages need the spelling: what cannot be among the first by score goes before.
    lang_of = words.select(F.col("h").alias("first"), "lang")
    scored = scored.withColumn("first", F.col("words")[0]).join(lang_of, "first").drop("first")
    shares = split_key(SEGMENTS, "words")
    order = Window.partitionBy("lang", "share").orderBy(F.desc("score"), F.desc("a"))
    near = scored.withColumn("share", shares).withColumn("place", F.rank().over(order)).where(F.col("place") <= top)
    spelled = near.select("words", "lang", "a", "l", "r", "score", F.posexplode("words").alias("i", "h"))
    spelled = spelled.join(words.select("h", "word"), "h").groupBy("words", "lang", "a", "l", "r", "score").agg(
        F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"])).alias("phrase")
    )
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    first = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    own = Window.partitionBy("lang", "share").orderBy(*first)
    best = spelled.withColumn("share", shares).withColumn("place", F.row_number().over(own)).where(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*first))
    best = best.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
