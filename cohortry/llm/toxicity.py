"""Toxicity by a string-kernel support vector machine over the words of a text.

Two words are as alike as the three-letter subsequences they share, each weighted by a
decay per letter spanned, so gaps and inserted letters cost little. Landmarks give the
kernel's Nystroem features, in which a linear support vector machine is fitted. Its
decision is linear in the subsequences too, so all landmarks fold into one weight per
subsequence and a word costs a sum over its own subsequences.

Labels belong to documents, so examples come from them in two steps. Words that occur in
toxic documents far more often than chance allows (false discovery rate below
``FALSE_SHARE``, where copies of a text count once per label, as they don't occur independently) are the positive examples, also with a letter inserted or doubled, but for
those seen in more than one clean text per four toxic ones. All of them are examples; only
the landmarks among them are bounded (``POSITIVE_LANDMARKS``), chosen to lie far apart, so that
rarer languages keep theirs. Words of clean documents are the negative examples, the nearest
to the positives among them. A document
is judged by the highest margins of its words (the first, second, third and fifth, words
counting as often as they are written) and its number of different words, by a piecewise linear logistic function fitted on the labelled documents.

Labels are learned from about ``SAMPLE_DOCS`` documents of each class, chosen by hash. Marks
and digits inside words that stand for letters are read as letters, other marks are left
out, and runs of one- or two-letter words are also read as one word.

Defined results: null and empty texts have no words and get the score of a text whose
margins are all ``FLOOR``; without labelled documents of both classes every score is 0; a
document with several labels is toxic if one says so; a null doc_id is never held out and
never learned from; repeated rows give repeated rows; an empty table gives an empty one;
other columns don't matter.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import defaultdict
from dataclasses import dataclass
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.llm import near_dedup
from cohortry.llm.common import map_batches, type_of
from cohortry.sources.scratch import stored

DECAY = 0.5
SYMBOLS = 64
LONGEST = 24
SAMPLE_DOCS = 5_000
FALSE_SHARE = 0.05
# Texts that share this part of their near_dedup registers count as copies of each other.
COPY_SHARE = 0.25
POSITIVE_LANDMARKS = 96
NEGATIVE_LANDMARKS = 96
MAX_WEIGHT = 20
MACHINE_RIDGE = 1e-5
JUDGE_RIDGE = 1e-4
NEWTON_STEPS = 60
NEAR_NEGATIVES = 1_500
OTHER_NEGATIVES = 3_000
FLOOR = -2.0
CEILING = 5.0
KNEES = (0.0, 1.0, 1.8)
RANKS = (0, 1, 2, 4)
CACHED_WORDS = 200_000
TRIPLES_AT_ONCE = 300_000
THRESHOLD = 0.7

# Marks and digits commonly written for a letter.
STAND_INS = str.maketrans("013457$@!|", "oieastsaii")
_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")
_MARKS = re.compile(r"[\W\d_]+")
_RUN = re.compile(r"(?<!\S)(?:[^\W\d_]{1,2}\s+){3,}[^\W\d_]{1,2}(?!\S)")


def normalised(word: str) -> str:
    """Letters of a lower-case word: edges cut, stand-ins read, other marks left out."""
    if word.isalpha():
        return word
    return _MARKS.sub("", _EDGES.sub("", word).translate(STAND_INS))


def windows(letters: str) -> list[str]:
    """The word, or overlapping windows of a very long one."""
    if len(letters) <= LONGEST:
        return [letters] if len(letters) >= 3 else []
    return [letters[i : i + LONGEST] for i in range(0, len(letters) - LONGEST // 2, LONGEST // 2)]


def words_of(text: str | None) -> list[str]:
    lower = (text or "").lower()
    return lower.split() + ["".join(r.split()) for r in _RUN.findall(lower)]


@cache
def _triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index triples of a word of n letters, and their weights."""
    found = np.array(list(combinations(range(n), 3)), np.int64).reshape(-1, 3)
    return found, DECAY ** (found[:, 2] - found[:, 0] + 1).astype(float)


def _symbols(words: list[str]) -> np.ndarray:
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.int64)
    plain = (codes >= 97) & (codes <= 122)
    return np.where(plain, codes - 96, 27 + codes % (SYMBOLS - 27))


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and normalised weights of the subsequences of words of one length."""
    places, weights = _triples(len(words[0]))
    at = _symbols(words)
    codes = (at[:, places[:, 0]] * SYMBOLS + at[:, places[:, 1]]) * SYMBOLS + at[:, places[:, 2]]
    order = np.argsort(codes, axis=1, kind="stable")
    codes = np.take_along_axis(codes, order, axis=1)
    values = weights[order]
    # Weights of equal subsequences of a word add up before squaring.
    first = np.ones(codes.shape, bool)
    first[:, 1:] = codes[:, 1:] != codes[:, :-1]
    groups = np.cumsum(first.ravel()) - 1
    sums = np.bincount(groups, values.ravel())
    row_of = np.repeat(np.arange(len(words)), first.sum(axis=1))
    norms = np.sqrt(np.bincount(row_of, sums**2, minlength=len(words)))
    return codes, values / norms[:, None]


def _by_length(words: list[str]) -> dict[int, list[int]]:
    groups: dict[int, list[int]] = defaultdict(list)
    for i, w in enumerate(words):
        groups[len(w)].append(i)
    return groups


def spread(words: list[str], weights: np.ndarray) -> np.ndarray:
    """Sum of the words' feature vectors, each times its weight."""
    out = np.zeros(SYMBOLS**3)
    for members in _by_length(words).values():
        codes, values = subsequences([words[i] for i in members])
        out += np.bincount(codes.ravel(), (values * weights[members][:, None]).ravel(), minlength=len(out))
    return out


def products(words: list[str], vector: np.ndarray) -> np.ndarray:
    """Inner products of the words' feature vectors with a vector."""
    out = np.zeros(len(words))
    for length, members in _by_length(words).items():
        at_once = max(1, TRIPLES_AT_ONCE // math.comb(length, 3))
        for k in range(0, len(members), at_once):
            part = members[k : k + at_once]
            codes, values = subsequences([words[i] for i in part])
            out[part] = (values * vector[codes]).sum(axis=1)
    return out


def kernel(left: list[str], right: list[str]) -> np.ndarray:
    """Kernel matrix of two lists of words, over the subsequences of the shorter list."""
    parts = [(members, *subsequences([right[i] for i in members])) for members in _by_length(right).values()]
    known = np.unique(np.concatenate([codes.ravel() for _, codes, _ in parts]))
    columns = np.zeros((len(known) + 1, len(right)), np.float32)
    for members, codes, values in parts:
        owners = np.broadcast_to(np.array(members)[:, None], codes.shape)
        np.add.at(columns, (np.searchsorted(known, codes), owners), values)
    out = np.zeros((len(left), len(right)))
    for length, members in _by_length(left).items():
        at_once = max(1, TRIPLES_AT_ONCE // (50 * math.comb(length, 3)))
        for k in range(0, len(members), at_once):
            part = members[k : k + at_once]
            codes, values = subsequences([left[i] for i in part])
            place = np.minimum(np.searchsorted(known, codes), len(known) - 1)
            place[known[place] != codes] = len(known)  # a row of zeros
            out[part] = np.einsum("nt,ntm->nm", values, columns[place])
    return out


@dataclass
class Scorer:
    """The folded machine and the logistic function over a text's evidence."""

    weights: np.ndarray
    bias: float
    logistic: tuple[float, ...] = (0.0,) * (len(RANKS) * (1 + len(KNEES)) + 2)

    def __post_init__(self) -> None:
        self._margins: dict[str, float] = {}

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "bias": self.bias, "logistic": self.logistic, "_margins": {}}

    def _learn(self, words: set[str]) -> None:
        parts, owners = [], []
        for w in words:
            for letters in windows(normalised(w)):
                parts.append(letters)
                owners.append(w)
        for w in words:
            self._margins[w] = FLOOR
        for w, margin in zip(owners, products(parts, self.weights) + self.bias):
            self._margins[w] = max(self._margins[w], float(margin))

    def evidence(self, texts: list[str | None]) -> list[list[float]]:
        """The margins of each text at ``RANKS``, bent at ``KNEES``, and the logarithm of its different words."""
        out = []
        for at in range(0, len(texts), 200):
            lists = [words_of(t) for t in texts[at : at + 200]]
            sets = [set(words) for words in lists]
            if len(self._margins) > CACHED_WORDS:
                self._margins.clear()
            self._learn(set().union(*sets) - self._margins.keys())
            for every, words in zip(lists, sets):
                top = heapq.nlargest(RANKS[-1] + 1, words, self._margins.__getitem__)
                # A telling word counts as often as it is written.
                top = [m for w in top for m in [self._margins[w]] * (every.count(w) if self._margins[w] > 0 else 1)]
                top += [FLOOR] * (RANKS[-1] + 1 - len(top))
                marks = [min(max(top[r], FLOOR), CEILING) for r in RANKS]
                out.append([*marks, *(max(m - k, 0.0) for m in marks for k in KNEES), math.log1p(len(words))])
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        *slopes, constant = self.logistic
        rows = np.array(self.evidence(texts)).reshape(-1, len(slopes))
        return 1 / (1 + np.exp(-np.clip(rows @ np.array(slopes) + constant, -500, 500)))


def labelled_sample(docs: DataFrame, labels: DataFrame, learnable: Column, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, text, toxic of about ``sample_docs`` learnable documents per class, stored."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & learnable)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    scale = 1_000_000
    share = F.lit(0)
    for label, n in sorted(sizes.items()):
        share = F.when(F.col("toxic") == label, min(scale, -(-sample_docs * scale // n))).otherwise(share)
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < share)
    # The sample is bounded by its parameter, hence the broadcast.
    return stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "toxic-sample")


def copy_groups(registers: list[bytes]) -> dict[bytes, int]:
    """A group per row of registers: that of the earlier group's first row it shares most with, or a new one."""
    groups: dict[bytes, int] = {}
    first = np.zeros((len(registers), near_dedup.BUCKETS), np.uint16)
    filled, n = np.zeros(len(registers), np.int64), 0
    for row in sorted(set(registers)):
        own = np.frombuffer(row, np.uint16)
        size = np.count_nonzero(own)
        share = np.count_nonzero((first[:n] == own) & (own > 0), axis=1) / np.maximum(np.maximum(filled[:n], size), 1)
        if n and share.max() >= COPY_SHARE:
            groups[row] = int(share.argmax())
        else:
            first[n], filled[n], groups[row] = own, size, n
            n += 1
    return groups


def _sketched(sample: DataFrame) -> tuple[DataFrame, dict[bytes, int]]:
    """text, toxic, registers of the sample, and the groups of copies by registers."""

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        regs = [near_dedup.registers(near_dedup.shingles(t)).tobytes() for t in batch.column("text").to_pylist()]
        return {"text": batch.column("text"), "toxic": batch.column("toxic"), "registers": pa.array(regs, pa.binary())}

    rows = map_batches(sample.select("text", F.col("toxic").cast("int").alias("toxic")), work, "text string, toxic int, registers binary")
    rows = stored(rows, "toxic-sketch")
    return rows, copy_groups([bytes(r["registers"]) for r in rows.select("registers").distinct().collect()])


def _word_counts(sketched: DataFrame, groups: dict[bytes, int]) -> pd.DataFrame:
    """In how many toxic and clean texts of the sample each word occurs, copies of a text counting once per label."""
    shared = sketched.sparkSession.sparkContext.broadcast(groups)

    def find(batch: pa.RecordBatch) -> dict[str, object]:
        found = set()
        for text, label, regs in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "registers"))):
            group = shared.value[regs]
            found |= {(x, label, group) for w in set(words_of(text)) for x in windows(normalised(w))}
        words, labels, owners = zip(*found) if found else ((), (), ())
        return {"word": pa.array(words, pa.string()), "toxic": pa.array(labels, pa.int32()), "copies": pa.array(owners, pa.int32())}

    rows = map_batches(sketched, find, "word string, toxic int, copies int").distinct()
    rows = rows.groupBy("word", "toxic").agg(F.count(F.lit(1)).alias("n"))
    sums = rows.groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean")
    )
    # A word seen once tells nothing; of clean words a hashed share is enough.
    rare = F.pmod(F.xxhash64("word"), F.lit(50)) == 0
    return sums.where((F.col("bad") >= 2) | (F.col("clean") >= 2) & rare).toPandas().sort_values("word", ignore_index=True)


def telling_words(counts: pd.DataFrame, toxic_share: float) -> list[str]:
    """Words that mark toxic documents, most certain first, by the Benjamini-Hochberg rule."""
    n = counts["bad"] + counts["clean"]
    ratio = toxic_share / (1 - toxic_share)
    # Chance of at least this many toxic documents among the word's documents, bounded by its leading term.
    exponent = [
        _log_comb(int(t), int(b)) + b * np.log(toxic_share) + c * np.log(1 - toxic_share) if b > t * toxic_share else 0.0
        for t, b, c in zip(n, counts["bad"], counts["clean"])
    ]
    p = np.minimum(0.0, np.array(exponent) + np.log1p(ratio))
    order = np.lexsort((counts["word"], p))
    limits = np.log(FALSE_SHARE) + np.log(np.arange(1, len(p) + 1)) - np.log(max(1, len(p)))
    passing = np.flatnonzero(p[order] <= limits)
    chosen = order[: passing.max() + 1] if len(passing) else order[:0]
    precise = [i for i in chosen if counts["bad"][i] >= 4 * counts["clean"][i]]
    return [counts["word"][i] for i in precise]


def _log_comb(n: int, k: int) -> float:
    return float(np.log(float(math.comb(n, k)))) if n < 900 else float(n * np.log(n) - k * np.log(max(k, 1)) - (n - k) * np.log(max(n - k, 1)))


def variants(word: str) -> list[str]:
    """The word with one letter inserted or doubled, at places that follow from the word."""
    out = [word]
    for i in range(1, len(word)):
        out.append(word[:i] + "x" + word[i:])
        out.append(word[:i] + word[i - 1] + word[i:])
    return [w for v in out for w in windows(v)]


def fit_linear(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float, hinge: bool) -> tuple[np.ndarray, float]:
    """Slopes and constant of a linear machine (squared hinge loss) or a logistic one, by Newton steps.

    The examples are a bounded sample in at most a few hundred dimensions, so the solve is a small one.
    """
    rows = np.hstack([x, np.ones((len(x), 1))])
    sign, total = 2.0 * y - 1, cost.sum()
    penalty = np.full(rows.shape[1], ridge)
    penalty[-1] = 1e-9

    def parts(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        z = sign * (rows @ w)
        if hinge:
            short = np.maximum(0.0, 1 - z)
            return (cost * short**2).sum() / total, -2 * cost * sign * short, 2 * cost * (short > 0)
        p = 1 / (1 + np.exp(np.clip(z, -500, 500)))
        return (cost * np.logaddexp(0, -z)).sum() / total, -cost * sign * p, cost * p * (1 - p)

    w = np.zeros(rows.shape[1])
    loss, slope, bend = parts(w)
    for _ in range(NEWTON_STEPS):
        gradient = rows.T @ slope / total + penalty * w
        hessian = (rows.T * bend) @ rows / total + np.diag(penalty)
        move = np.linalg.solve(hessian + 1e-10 * np.eye(len(w)), gradient)
        value, step = loss + (penalty * w**2).sum() / 2, 1.0
        while step > 1e-6:
            loss, slope, bend = parts(w - step * move)
            if loss + (penalty * (w - step * move) ** 2).sum() / 2 <= value:
                break
            step /= 2
        w = w - step * move
        if step <= 1e-6 or np.abs(step * move).max() < 1e-7:
            break
    return w[:-1], float(w[-1])


def spread_landmarks(words: list[str], limit: int) -> list[str]:
    """At most ``limit`` of the words, each the one that those before it leave least explained (pivoted Cholesky)."""
    if len(words) <= limit:
        return words
    left, rows, chosen = np.ones(len(words)), np.zeros((len(words), limit)), []
    for k in range(limit):
        i = int(left.argmax())
        if left[i] < 1e-6:
            break
        alike = products(words, spread([words[i]], np.ones(1)))
        rows[:, k] = (alike - rows[:, :k] @ rows[i, :k]) / np.sqrt(left[i])
        left = left - rows[:, k] ** 2
        chosen.append(words[i])
    return chosen


def fit_machine(positives: list[str], negatives: list[str], common: list[int]) -> tuple[np.ndarray, float]:
    """Weights per subsequence and bias of the machine in Nystroem features.

    ``common`` says in how many clean documents each negative example occurs, its weight up to ``MAX_WEIGHT``.
    Half of the negative landmarks are the negatives nearest to the positives, where the border runs.
    """
    near = products(negatives, spread(positives, np.ones(len(positives))))
    closeness = np.argsort(-near, kind="stable")
    step = max(1, len(closeness) // OTHER_NEGATIVES)
    chosen = list(dict.fromkeys([*closeness[:NEAR_NEGATIVES], *closeness[::step]]))
    negative = [negatives[i] for i in chosen]
    costs = [float(min(common[i], MAX_WEIGHT)) for i in chosen]
    across = np.linspace(0, len(negative) - 1, min(NEGATIVE_LANDMARKS // 2, len(negative))).astype(int)
    landmarks = list(dict.fromkeys([*spread_landmarks(positives, POSITIVE_LANDMARKS), *negative[: NEGATIVE_LANDMARKS // 2], *(negative[i] for i in across)]))
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks))
    sound = values > 1e-6
    root = vectors[:, sound] / np.sqrt(values[sound])
    positive = [v for w in positives for v in variants(w)]
    examples = kernel(positive + negative, landmarks) @ root
    weight = np.array([sum(costs) / len(positive)] * len(positive) + costs)
    labels = np.array([1.0] * len(positive) + [0.0] * len(negative))
    slopes, bias = fit_linear(examples, labels, weight, MACHINE_RIDGE, hinge=True)
    return spread(landmarks, root @ slopes), bias


def train(docs: DataFrame, labels: DataFrame, learnable: Column, sample_docs: int = SAMPLE_DOCS) -> Scorer | None:
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, learnable, sample_docs)
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return None
    sketched, groups = _sketched(sample)
    counts = _word_counts(sketched, groups)
    labelled = {(r["toxic"], groups[bytes(r["registers"])]) for r in sketched.select("toxic", "registers").distinct().collect()}
    toxic_share = sum(label for label, _ in labelled) / len(labelled)
    positives = telling_words(counts, toxic_share)
    # Words no more common in toxic documents than chance has it; what lies between tells nothing.
    usual = counts["bad"] <= 2 * toxic_share * (counts["bad"] + counts["clean"])
    others = counts[usual & ~counts["word"].isin(positives)]
    negatives, common = list(others["word"]), list(others["clean"])
    if not positives or not negatives:
        return None
    weights, bias = fit_machine(positives, negatives, common)
    machine = spark.sparkContext.broadcast(Scorer(weights, bias))

    def measure(batch: pa.RecordBatch) -> dict[str, object]:
        found = machine.value.evidence(batch.column("text").to_pylist())
        return {"toxic": batch.column("toxic"), "evidence": pa.array(found, pa.list_(pa.float64()))}

    kind = type_of(sample, "toxic")
    rows = map_batches(sample.select("toxic", "text"), measure, f"toxic {kind}, evidence array<double>").collect()
    evidence, label = np.array([r["evidence"] for r in rows]), np.array([float(r["toxic"]) for r in rows])
    slopes, constant = fit_linear(evidence, label, np.ones(len(rows)), JUDGE_RIDGE, hinge=False)
    return Scorer(weights, bias, (*map(float, slopes), constant))


def score_texts(docs: DataFrame, scorer: Scorer | None, held_out: Column, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    if scorer is None:
        return rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def judge(batch: pa.RecordBatch) -> dict[str, object]:
        score = shared.value.scores(batch.column("text").to_pylist())
        return {
            "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": pa.array(score, pa.float64()),
            "predicted": pa.array((score >= threshold).astype(np.int32), pa.int32()),
        }

    return map_batches(rows, judge, f"doc_id {type_of(docs, 'doc_id')}, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, scorer: Scorer | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not judged toxic, with all their columns."""
    if scorer is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def keep(batch: pa.RecordBatch) -> dict[str, object]:
        mask = shared.value.scores(batch.column("text").to_pylist()) < threshold
        kept = batch.filter(pa.array(mask))
        return {name: kept.column(i) for i, name in enumerate(kept.schema.names)}

    schema = docs.schema
    return map_batches(docs, keep, schema)
