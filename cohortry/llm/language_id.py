"""Language identification by character models with interpolated Kneser-Ney smoothing.

Texts become lower-case letters with single spaces between runs of them. Per language, grams
of up to five characters are counted on a sample of labelled documents (about
``SAMPLE_DOCS`` per language, chosen by hash, whole texts). The models of all languages lie
in one sorted array of gram hashes per order, with a discounted probability and a back-off
weight per language beside it. A text goes to the language of the lowest cross-entropy per
character. Part of the sample is left out of the counts and calibrates the temperature of
the score and, per language, the cross-entropy beyond which a prediction is rejected.

Defined results: null texts and texts without a letter are ``und`` with score 0; ties go
to the language that sorts first; without labelled documents every text is ``und``; a null
doc_id is never held out and never learned from; repeated rows give repeated rows; an
empty table gives an empty one; other columns don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.llm.common import map_batches, type_of

ORDER = 5
SAMPLE_DOCS = 800
CALIBRATE_EVERY = 4
UNKNOWN = "und"
ALPHABET = 512
BETWEEN = ord(" ")
CHARS_AT_ONCE = 2_000_000
REJECT_QUANTILE = 0.995
TEMPERATURES = (5.0, 10.0, 20.0, 40.0, 80.0)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def remainder(divisor: int) -> Column:
    """crc32 of the doc_id as text modulo ``divisor``."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor


def _letters() -> np.ndarray:
    table = np.full(0x10000, BETWEEN, np.uint64)
    for code in range(0x10000):
        if chr(code).isalpha():
            table[code] = ord(chr(code).lower()[0])
    return table


_LETTERS = _letters()


def characters(text: str | None) -> np.ndarray:
    """Letters in lower case, each other run of characters as one space, with a space at both ends."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
    out = np.full(len(codes) + 2, BETWEEN, np.uint64)
    out[1:-1] = _LETTERS[np.minimum(codes, 0xFFFF)]
    for i in np.flatnonzero(codes > 0xFFFF):
        out[i + 1] = codes[i] if chr(codes[i]).isalpha() else BETWEEN
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != BETWEEN) | (out[:-1] != BETWEEN)
    return out[keep]


def _padded(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array; where each text's characters to be predicted start and how many there are."""
    parts, starts, lengths, at = [], [], [], 0
    pad = np.full(ORDER - 2, BETWEEN, np.uint64)
    for text in texts:
        chars = characters(text)
        parts += [pad, chars]
        starts.append(at + ORDER - 1)
        lengths.append(max(0, len(chars) - 1) if len(chars) > 1 else 0)
        at += len(pad) + len(chars)
    return np.concatenate(parts) if parts else pad, np.array(starts, np.int64), np.array(lengths, np.int64)


def gram_hash(chars: np.ndarray, ends: np.ndarray, order: int, last: int = 0) -> np.ndarray:
    """Hashes of the ``order`` characters that end ``last`` characters before ``ends``."""
    out = np.full(len(ends), order, np.uint64)
    for back in range(order - 1 + last, last - 1, -1):
        out = out * _BASE + chars[ends - back]
        out ^= out >> np.uint64(29)
    return out


def _positions(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    total = int(lengths.sum())
    offsets = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return np.arange(total) + offsets


@dataclass
class Order:
    """Sorted hashes of one order with a column per language."""

    grams: np.ndarray
    discounted: np.ndarray
    contexts: np.ndarray
    backoff: np.ndarray


@dataclass
class Models:
    languages: list[str]
    orders: list[Order]
    temperature: float = TEMPERATURES[0]
    limits: np.ndarray | None = None

    def log_probabilities(self, chars: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each character at ``ends``, per language."""
        p = np.full((len(ends), len(self.languages)), 1.0 / ALPHABET)
        for n, order in enumerate(self.orders, start=1):
            lam = _rows(order.contexts, order.backoff, gram_hash(chars, ends, n - 1, 1), 1.0)
            p = _rows(order.grams, order.discounted, gram_hash(chars, ends, n), 0.0) + lam * p
        return np.log(p)

    def cross_entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Nats per character of each text under each language, and whether it has a letter."""
        out, lettered = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), bool)
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end] or "") <= CHARS_AT_ONCE):
                size += len(texts[end] or "")
                end += 1
            chars, starts, lengths = _padded(texts[at:end])
            positions = _positions(starts, lengths)
            if len(positions):
                codes, _ = pd.factorize(gram_hash(chars, positions, ORDER))
                first = np.empty(codes.max() + 1, np.int64)
                first[codes[::-1]] = positions[::-1]
                logs = self.log_probabilities(chars, first)
                full = np.flatnonzero(lengths)
                cuts = np.concatenate([[0], np.cumsum(lengths)[:-1]])[full]
                for k in range(len(self.languages)):
                    out[at + full, k] = -np.add.reduceat(logs[codes, k], cuts) / lengths[full]
                lettered[at + full] = np.add.reduceat(chars[positions] != BETWEEN, cuts) > 0
            at = end
        return out, lettered

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether the prediction is rejected."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        entropy, lettered = self.cross_entropies(texts)
        best = entropy.argmin(axis=1)
        lowest = entropy[np.arange(len(texts)), best]
        score = 1 / np.exp(-(entropy - lowest[:, None]) * self.temperature).sum(axis=1)
        limit = self.limits[best] if self.limits is not None else np.inf
        rejected = ~lettered | (lowest > limit)
        score = np.where(lettered, np.where(rejected, score * limit / np.maximum(lowest, 1e-9), score), 0.0)
        names = [self.languages[b] if has else UNKNOWN for b, has in zip(best, lettered)]
        return names, score, rejected


def _rows(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where((keys[at] == wanted)[:, None], values[at], default)


def fit_models(counts: pd.DataFrame) -> Models:
    """Kneser-Ney models from a table lang, gram (ORDER characters), n.

    The highest order uses counts, the others the number of different characters before a gram.
    """
    languages = sorted(counts["lang"].unique())
    orders: list[Order] = []
    grams = counts[["lang", "gram", "n"]]
    for order in range(ORDER, 0, -1):
        orders.insert(0, _fit_order(grams, order, languages))
        shorter = grams.assign(gram=grams["gram"].str[1:]).groupby(["lang", "gram"], as_index=False)
        grams = shorter.size().rename(columns={"size": "n"})
    return Models(languages, orders)


def _fit_order(grams: pd.DataFrame, order: int, languages: list[str]) -> Order:
    once = grams["n"].eq(1).groupby(grams["lang"]).sum()
    twice = grams["n"].eq(2).groupby(grams["lang"]).sum()
    discounts = ((once + 0.5) / (once + 2 * twice + 1.0)).clip(0.1, 0.9)
    work = grams.assign(context=grams["gram"].str[:-1], d=grams["lang"].map(discounts))
    by_context = work.groupby(["lang", "context"], as_index=False).agg(total=("n", "sum"), kinds=("n", "size"), d=("d", "first"))
    by_context["weight"] = by_context["d"] * by_context["kinds"] / by_context["total"]
    work = work.merge(by_context[["lang", "context", "total"]], on=["lang", "context"])
    work["weight"] = (work["n"] - work["d"]) / work["total"]
    keys, values = _table(work, "gram", order, languages, 0.0)
    contexts, backoff = _table(by_context, "context", order - 1, languages, 1.0)
    return Order(keys, values, contexts, backoff)


def _table(rows: pd.DataFrame, column: str, order: int, languages: list[str], default: float) -> tuple[np.ndarray, np.ndarray]:
    codes, names = pd.factorize(rows[column])
    chars = np.frombuffer("".join(names).encode("utf-32-le"), np.uint32).astype(np.uint64)
    ends = np.arange(len(names)) * order + order - 1 if order else np.zeros(len(names), np.int64)
    hashes = gram_hash(chars, ends, order)
    values = np.full((len(names), len(languages)), default)
    values[codes, rows["lang"].map({l: i for i, l in enumerate(languages)}).to_numpy()] = rows["weight"].to_numpy()
    by_hash = np.argsort(hashes)
    return hashes[by_hash], values[by_hash]


def _gram_counts(sample: DataFrame) -> pd.DataFrame:
    """Counts of full-order grams per language; bounded by the sample."""

    def count(batch: pa.RecordBatch) -> dict[str, object]:
        langs = np.array(batch.column("lang").to_pylist(), object)
        texts = batch.column("text").to_pylist()
        parts = []
        for lang in sorted(set(langs)):
            chars, starts, lengths = _padded([texts[i] for i in np.flatnonzero(langs == lang)])
            letters = chars.astype(np.uint32).tobytes().decode("utf-32-le")
            grams = pd.Series([letters[p - ORDER + 1 : p + 1] for p in _positions(starts, lengths)], dtype=object)
            found = grams.value_counts()
            parts.append(pd.DataFrame({"lang": lang, "gram": found.index, "n": found.to_numpy()}))
        rows = pd.concat(parts) if parts else pd.DataFrame({"lang": [], "gram": [], "n": []})
        return {"lang": pa.array(rows["lang"], pa.string()), "gram": pa.array(rows["gram"], pa.string()), "n": pa.array(rows["n"], pa.int64())}

    found = map_batches(sample.select("lang", "text"), count, "lang string, gram string, n bigint")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas().sort_values(["lang", "gram"], ignore_index=True)


def train(docs: DataFrame, learnable: Column, sample_docs: int = SAMPLE_DOCS) -> Models:
    """Fit and calibrate on about ``sample_docs`` documents of each language among the learnable ones."""
    known = docs.where(learnable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Models([], [])
    scale = 1_000_000
    shares = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(scale, -(-sample_docs * scale // n)))])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(scale))
    sample = known.where(place < F.element_at(shares, F.col("lang")))
    for_counts = (F.pmod(F.xxhash64(F.lit("calibrate"), F.col("doc_id")), F.lit(CALIBRATE_EVERY)) != 0)
    models = fit_models(_gram_counts(sample.where(for_counts)))
    if models.languages:
        _calibrate(models, sample.where(~for_counts & F.col("lang").isin(models.languages)))
    return models


def _calibrate(models: Models, sample: DataFrame) -> None:
    """Choose the temperature by log loss, the limits by a quantile under the true language."""
    shared = sample.sparkSession.sparkContext.broadcast(models)

    def measure(batch: pa.RecordBatch) -> dict[str, object]:
        entropy, lettered = shared.value.cross_entropies(batch.column("text").to_pylist())
        rows = [e.tolist() if has else None for e, has in zip(entropy, lettered)]
        return {"lang": batch.column("lang"), "entropy": pa.array(rows, pa.list_(pa.float64()))}

    rows = map_batches(sample.select("lang", "text"), measure, "lang string, entropy array<double>").where("entropy is not null").collect()
    models.limits = np.full(len(models.languages), np.inf)
    if not rows:
        return
    entropy = np.array([r["entropy"] for r in rows])
    true = np.array([models.languages.index(r["lang"]) for r in rows])
    excess = entropy - entropy.min(axis=1, keepdims=True)
    own = excess[np.arange(len(true)), true]
    losses = [np.mean(np.log(np.exp(-excess * t).sum(axis=1)) + own * t) for t in TEMPERATURES]
    models.temperature = TEMPERATURES[int(np.argmin(losses))]
    for k in range(len(models.languages)):
        mine = entropy[true == k, k]
        if len(mine):
            models.limits[k] = np.quantile(mine, REJECT_QUANTILE) + 2 * mine.std()


def identify(docs: DataFrame, models: Models, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def predict(batch: pa.RecordBatch) -> dict[str, object]:
        names, score, rejected = shared.value.predict(batch.column("text").to_pylist())
        return {
            "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "lang_pred": pa.array(names, pa.string()),
            "score": pa.array(score, pa.float64()), "rejected": pa.array(rejected, pa.bool_()),
        }

    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    return map_batches(rows, predict, f"doc_id {type_of(docs, 'doc_id')}, held_out boolean, lang_pred string, score double, rejected boolean")
