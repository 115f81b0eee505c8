"""URL rules behind a Bloom filter cascade.

A URL's keys are its host suffixes at label boundaries combined with prefixes of its path,
of the lengths that rules have. The distinct keys of the whole corpus are the universe.
Per verdict a cascade is built: level 0 encodes the listed keys, level 1 the keys of the
universe that pass level 0 without being listed, level 2 the listed keys that pass level 1,
and so on until nothing passes wrongly. On its universe a cascade answers exactly, so
urls are judged in one pass over the table with no join: the longest key that a cascade
holds is the rule. A URL without a rule gets the default verdict.

The first level's error rate follows from the sizes of list and universe, so that the
later levels hold about as many keys as the list; filters travel by broadcast and grow
with the list (a parameter of the query) and not with the corpus.

Defined results: a null url or one without ``://`` has empty host and path and the default
verdict; an empty path fits rules with an empty path only; of rules that fit, the one with
the longest host plus path wins, then the one with the longer host; repeated rows are
judged each; an empty table gives an empty one; other columns don't matter.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.llm.common import map_batches, type_of
from cohortry.sources.scratch import stored

# The rules of the contract, (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DEFAULT = "allow"
LATER_ERROR = 0.5
MAX_LEVELS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def keys_of(host: str, path: str, lengths: list[int], longest: int) -> list[str]:
    """The keys under which a rule may list this URL, the longest first; no rule's host has more than ``longest`` characters."""
    near = max(0, len(host) - longest)
    at = [*([0] if not near else []), *(near + i for i, c in enumerate(host[max(0, near - 1) :], 0 if near else 1) if c == ".")]
    suffixes = list(dict.fromkeys(host[i:] for i in at if i < len(host) or not host))
    keys = [(len(s) + n, len(s), f"{s}{path[:n]}") for s in suffixes for n in lengths if n <= len(path)]
    return [key for *_, key in sorted(keys, reverse=True)]


@dataclass(frozen=True)
class Level:
    """One Bloom filter: bits, number of bits, number of probes, seed."""

    words: np.ndarray
    size: int
    probes: int
    seed: int

    def __contains__(self, key: str) -> bool:
        return all(self.words[p >> 6] >> np.uint64(p & 63) & np.uint64(1) for p in positions(key, self.size, self.probes, self.seed))


def positions(key: str, size: int, probes: int, seed: int) -> list[int]:
    pair = xxhash.xxh3_128_intdigest(key.encode("utf-8", "replace"), seed)
    first, step = pair & 0xFFFFFFFFFFFFFFFF, pair >> 64 | 1
    return [(first + i * step) % size for i in range(probes)]


def in_cascade(levels: list[Level], key: str) -> bool:
    """Membership: the number of levels passed in a row is odd for listed keys."""
    for depth, level in enumerate(levels):
        if key not in level:
            return depth % 2 == 1
    return len(levels) % 2 == 1


def _level(keys: DataFrame, n: int, error: float, seed: int) -> Level:
    """Encode a table of keys. Tasks reduce to words of 64 bits; their number is bounded by the filter."""
    size = max(64, math.ceil(-n * math.log(error) / math.log(2) ** 2))
    probes = max(1, round(size / n * math.log(2)))

    def bits(batch: pa.RecordBatch) -> dict[str, object]:
        words: dict[int, int] = {}
        for key in batch.column("key").to_pylist():
            for p in positions(key, size, probes, seed):
                words[p >> 6] = words.get(p >> 6, 0) | 1 << (p & 63)
        values = np.fromiter(words.values(), np.uint64, len(words)).view(np.int64)
        return {"word": pa.array(words.keys(), pa.int64()), "bits": pa.array(values)}

    found = map_batches(keys, bits, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    words = np.zeros(-(-size // 64), np.uint64)
    for row in found.toLocalIterator():
        words[row["word"]] = np.int64(row["bits"]).astype(np.uint64)
    return Level(words, size, probes, seed)


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def test(batch: pa.RecordBatch) -> dict[str, object]:
        return {"key": pa.array([k for k in batch.column("key").to_pylist() if k in shared.value], pa.string())}

    return map_batches(keys, test, "key string")


def cascade(listed: DataFrame, others: DataFrame) -> list[Level]:
    """Levels for distinct ``listed`` keys against distinct ``others`` (both: column key)."""
    levels: list[Level] = []
    inside, outside, n, rest = listed, others, listed.count(), others.count()
    error = min(LATER_ERROR, n / (math.sqrt(2) * max(1, rest)))
    while n:
        if len(levels) == MAX_LEVELS:
            raise ValueError("the key sets share keys")
        levels.append(_level(inside, n, error, len(levels)))
        wrong = stored(_passing(outside, levels[-1]), "url-level")
        inside, outside, n, error = wrong, inside, wrong.count(), LATER_ERROR
    return levels


def judge_urls(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule, verdict of every row."""
    spark = pages.sparkSession
    lengths, longest = sorted({len(path) for *_, path in rules}), max((len(host) for _, host, _ in rules), default=0)
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))

    def spread(batch: pa.RecordBatch) -> dict[str, object]:
        pairs = set(zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()))
        return {"key": pa.array(list({k for h, p in pairs for k in keys_of(h, p, lengths, longest)}), pa.string())}

    universe = stored(map_batches(urls.select("host", "path"), spread, "key string").distinct(), "url-universe")
    cascades: dict[str, list[Level]] = {}
    for verdict in dict.fromkeys(v for v, *_ in rules):
        listed = spark.createDataFrame(sorted({(f"{h}{p}",) for v, h, p in rules if v == verdict}), "key string")
        cascades[verdict] = cascade(listed, universe.join(F.broadcast(listed), "key", "left_anti"))
    shared = spark.sparkContext.broadcast(cascades)

    def judge(batch: pa.RecordBatch) -> dict[str, object]:
        found, verdicts, known = [], [], {}
        for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()):
            hit = (None, default)
            for key in keys_of(host, path, lengths, longest):
                if key not in known:
                    known[key] = next((v for v, levels in shared.value.items() if in_cascade(levels, key)), None)
                if known[key]:
                    hit = (key, known[key])
                    break
            found.append(hit[0])
            verdicts.append(hit[1])
        columns = {name: batch.column(name) for name in ("page_id", "host", "path")}
        return columns | {"rule": pa.array(found, pa.string()), "verdict": pa.array(verdicts, pa.string())}

    return map_batches(urls, judge, f"page_id {type_of(pages, 'page_id')}, host string, path string, rule string, verdict string")
