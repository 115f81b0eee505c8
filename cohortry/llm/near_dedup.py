"""Near-duplicate documents by HyperMinHash.

A document's set holds 64-bit hashes of its five-word shingles. Seven bits of a hash choose
one of 128 buckets; a bucket's register keeps its smallest hash as a count of leading zeros
and the ten bits after them. Four registers make a band, empty ones borrowing from a filled
bucket by a fixed rule; documents that share a band meet. Of each pair that meets, the
Jaccard similarity is estimated from equal registers, corrected for chance collisions, and
pairs that may reach the threshold are confirmed on the full sets.

No group of documents is expanded into its pairs. Equal sets are one class with one
representative. In each band the most central class is the hub, and the others are
compared with it. Confirmed links are contracted into components. Only where a band still
holds several components are members of different components compared, in blocks inside
a task, and only links that join components leave it. A pair that is never compared meets
in no band or lies in one component already.

Defined results: empty texts, and texts of white space, have no shingles and link with
nothing; fewer than five words make one shingle; rows that repeat a doc_id are one document
with all of their texts' links, of which one row stays in ``keep_one_of_each``; a null doc_id links with
nothing, is its own component and stays; an empty table gives an empty one; other columns don't matter.
An error is raised if components don't settle within ``MAX_ROUNDS`` rounds; each round at least halves paths.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortry.llm.common import importable, map_batches
from cohortry.sources.scratch import stored

SHINGLE = 5
THRESHOLD = 75  # percent
BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
ROWS = 4
BANDS = BUCKETS // ROWS
# Standard deviations by which an estimate may fall short before a pair is dropped.
SLACK = 5.0
BLOCK = 4_096
CACHED_WORDS = 200_000
REGISTERS_AT_ONCE = 64
MAX_ROUNDS = 100

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_REST = np.uint64((1 << (64 - BUCKET_BITS)) - 1)


class WordHashes(dict):
    """Word -> 64-bit hash; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = WordHashes()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of a text's distinct shingles."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = min(SHINGLE, len(words))
    total = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        total += hashes[i : len(words) - n + 1 + i] * _FACTORS[i]
    return np.unique(_mixed(total))


def registers(hashes: np.ndarray) -> np.ndarray:
    """Per bucket leading zeros (from 1) and mantissa of its smallest hash; 0 if it is empty."""
    out = np.zeros(BUCKETS, np.uint16)
    buckets = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    filled, first = np.unique(buckets, return_index=True)
    smallest = hashes[first] & _REST
    # Doubles are exact to the leading bit below 2**53; the shift keeps the ten bits after it.
    low = np.maximum(smallest >> np.uint64(MANTISSA_BITS), 1)
    bits = np.frexp(low.astype(np.float64))[1].astype(np.int64)
    over = (np.uint64(1) << np.minimum(bits, 62).astype(np.uint64)) > low * np.uint64(2)
    bits -= over
    zeros = 64 - BUCKET_BITS - MANTISSA_BITS - bits
    mantissa = (smallest >> bits.astype(np.uint64)) & np.uint64((1 << MANTISSA_BITS) - 1)
    out[filled] = ((zeros + 1) << MANTISSA_BITS) | mantissa.astype(np.int64)
    return out


def _borrowing(buckets: int) -> np.ndarray:
    """For each bucket the order in which it looks for a filled one."""
    rng = np.random.RandomState(7)
    return np.stack([np.concatenate([[i], rng.permutation(buckets)]) for i in range(buckets)])


_LOOK = _borrowing(BUCKETS)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One key per band for rows of registers."""
    n = len(regs)
    step = (regs > 0)[:, _LOOK].argmax(axis=2)
    source = _LOOK[np.arange(BUCKETS)[None, :], step]
    # A borrowed register also says from where, so that it differs from the lender's own place.
    dense = np.take_along_axis(regs, source, axis=1).astype(np.uint64) | (source.astype(np.uint64) << np.uint64(16))
    parts = dense.reshape(n, BANDS, ROWS)
    total = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * _FACTORS[4]
    for i in range(ROWS):
        total = _mixed(total + parts[:, :, i] * _FACTORS[i])
    return total.view(np.int64)


def chance_collision(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that registers of a bucket agree though their smallest hashes differ."""
    rates = [np.asarray(x, float)[..., None] / BUCKETS for x in (n, m)]
    steps = 2.0 ** -np.arange(64 - BUCKET_BITS - MANTISSA_BITS)
    same_zeros = [np.exp(-r * steps / 2) - np.exp(-r * steps) for r in rates]
    return (same_zeros[0] * same_zeros[1]).sum(axis=-1) / (1 << MANTISSA_BITS)


def may_reach(equal: np.ndarray, used: np.ndarray, n: np.ndarray, m: np.ndarray, threshold: int = THRESHOLD) -> np.ndarray:
    """Whether the corrected estimate lies within ``SLACK`` deviations of the threshold, and sizes allow it."""
    t = threshold / 100
    chance = chance_collision(n, m)
    estimate = (equal / np.maximum(used, 1) - chance) / (1 - chance)
    deviation = np.sqrt(t * (1 - t) / np.maximum(used, 1))
    return (estimate >= t - SLACK * deviation) & (100 * np.minimum(n, m) >= threshold * np.maximum(n, m))


def similar(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    """Exact test on full sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= threshold * (len(a) + len(b) - both) and both > 0


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key, registers of every row."""

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        sizes, keys, regs = [], [], []
        for text in batch.column("text").to_pylist():
            found = shingles(text)
            sizes.append(len(found))
            keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
            regs.append(registers(found).tobytes() if len(found) else None)
        return {
            "doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"), "n_shingles": pa.array(sizes, pa.int64()),
            "set_key": pa.array(keys, pa.binary()), "registers": pa.array(regs, pa.binary()),
        }

    return map_batches(_texts(docs), work, "doc_id bigint, text_key bigint, n_shingles bigint, set_key binary, registers binary")


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, text: the key tells the texts of one doc_id apart."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")


def _class_texts(reps: DataFrame, classes: DataFrame, docs: DataFrame, repeated: bool) -> DataFrame:
    """rep, text of the classes ``reps``: the text of each class's own row."""
    own = reps.join(classes.select("rep", "doc_id", "text_key"), "rep")
    found = _texts(docs).join(own, ["doc_id", "text_key"]).select("rep", "text")
    return found.groupBy("rep").agg(F.any_value("text").alias("text")) if repeated else found


def _bands(classes: DataFrame) -> DataFrame:
    """key, rep: one row per class and band."""

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        reps = batch.column("rep").to_numpy(zero_copy_only=False)
        blob = b"".join(batch.column("registers").to_pylist())
        regs = np.frombuffer(blob, np.uint16).reshape(-1, BUCKETS)
        keys = [band_keys(regs[i : i + REGISTERS_AT_ONCE]) for i in range(0, len(regs), REGISTERS_AT_ONCE)]
        keys = np.concatenate(keys).ravel() if keys else np.empty(0, np.int64)
        return {"key": pa.array(keys), "rep": pa.array(np.repeat(reps, BANDS).astype(np.int64))}

    return map_batches(classes.select("rep", "registers"), work, "key bigint, rep bigint")


def _candidates(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose corrected estimate may reach the threshold."""
    for side in ("a", "b"):
        mine = classes.select(F.col("rep").alias(side), F.col("n").alias(f"n_{side}"), F.col("registers").alias(f"r_{side}"))
        pairs = pairs.join(mine, side)

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        regs = [np.frombuffer(b"".join(batch.column(f"r_{s}").to_pylist()), np.uint16).reshape(-1, BUCKETS) for s in "ab"]
        sizes = [batch.column(f"n_{s}").to_numpy(zero_copy_only=False) for s in "ab"]
        equal = ((regs[0] == regs[1]) & (regs[0] > 0)).sum(axis=1)
        used = ((regs[0] > 0) | (regs[1] > 0)).sum(axis=1)
        kept = batch.filter(pa.array(may_reach(equal, used, *sizes, threshold)))
        return {"a": kept.column("a"), "b": kept.column("b")}

    return map_batches(pairs.select("a", "b", "n_a", "n_b", "r_a", "r_b"), work, "a bigint, b bigint")


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, repeated: bool, threshold: int) -> DataFrame:
    """The stored pairs (a, b) whose full sets reach the threshold."""
    involved = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    texts = stored(_class_texts(involved, classes, docs, repeated), "near-texts")
    joined = pairs.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("t_a")), "a")
    joined = joined.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("t_b")), "b")

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        last: tuple[str | None, np.ndarray] = (None, shingles(None))
        keep = []
        for one, other in zip(batch.column("t_a").to_pylist(), batch.column("t_b").to_pylist()):
            if other != last[0]:
                last = (other, shingles(other))
            keep.append(similar(shingles(one), last[1], threshold))
        kept = batch.filter(pa.array(keep, pa.bool_()))
        return {"a": kept.column("a"), "b": kept.column("b")}

    return map_batches(joined.select("a", "b", "t_a", "t_b"), work, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id per id: columns rep, component, for ids that have a link.

    Large and small stars in turn: every neighbour of a node is hung on the smallest id
    around it, until all edges point to their component's smallest id.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "near-edges")
    before = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = _star(both, F.col("v") > F.col("u"))  # larger neighbours move to the smallest one
        edges = _star(edges, F.lit(True))  # so do the smaller ones
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("rep"), F.col("v").alias("component"))
        before = state
    raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")


def _star(neighbours: DataFrame, moves: object) -> DataFrame:
    """Hang the neighbours that move, and the node itself, on the smallest id around."""
    least = stored(neighbours.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")), "near-least")
    hung = neighbours.where(moves).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return stored(hung.unionByName(own).where("u <> v").distinct(), "near-edges")


def _second_look(multi: DataFrame, classes: DataFrame, comps: DataFrame, docs: DataFrame, repeated: bool, threshold: int) -> DataFrame:
    """Links (a, b) between different components that share a band, enough to join what belongs together.

    Where a band holds several components, members outside its largest one are compared with all members,
    in blocks: by registers first, then on full sets, best estimate first. A link joins two components, whose
    other pairs need no test. Pairs stay inside the task; it returns at most one link per joined component.
    """
    labelled = multi.join(comps, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    labelled = stored(labelled, "near-labelled")
    # Bands of two were settled by their one pair.
    parts = labelled.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    bands = parts.groupBy("key").agg(F.sum("n").alias("members"), F.max(F.struct("n", "component")).alias("major"))
    bands = bands.where((F.col("members") > 2) & (F.col("major.n") < F.col("members")))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    bands = stored(bands.select(
        "key", F.col("major.component").alias("major"), blocks(F.col("members")).alias("blocks"),
        blocks(F.col("members") - F.col("major.n")).alias("outer_blocks"),
    ), "near-open")
    members = labelled.join(bands, "key").withColumn("outside", F.col("component") != F.col("major"))
    texts = stored(_class_texts(members.select("rep").distinct(), classes, docs, repeated), "near-texts")
    members = members.join(classes.select("rep", "n", "registers"), "rep").join(texts, "rep")
    own = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    columns = ("rep", "component", "n", "registers", "text")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    inner = members.select("key", upto("outer_blocks").alias("o"), own(F.col("blocks")).alias("m"), F.lit(False).alias("outside"), *columns)
    outer = members.where("outside").select("key", own(F.col("outer_blocks")).alias("o"), upto("blocks").alias("m"), "outside", *columns)

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["outside", "rep"], ignore_index=True)
        regs = np.frombuffer(b"".join(part["registers"]), np.uint16).reshape(-1, BUCKETS)
        n, rep, text = (part[c].to_numpy() for c in ("n", "rep", "text"))
        root = part["component"].to_numpy().copy()
        outside = part["outside"].to_numpy()
        right, sets = np.flatnonzero(~outside), {}

        def full(i: int) -> np.ndarray:
            if rep[i] not in sets:
                sets[rep[i]] = shingles(text[i])
            return sets[rep[i]]

        links = []
        for x in np.flatnonzero(outside):
            ys = right[root[right] != root[x]]
            equal = ((regs[ys] == regs[x]) & (regs[x] > 0)).sum(axis=1)
            used = ((regs[ys] > 0) | (regs[x] > 0)).sum(axis=1)
            passing = may_reach(equal, used, np.full(len(ys), n[x]), n[ys], threshold)
            for y in ys[passing][np.argsort(-equal[passing], kind="stable")]:
                if root[y] != root[x] and similar(full(x), full(y), threshold):
                    links.append((max(rep[x], rep[y]), min(rep[x], rep[y])))
                    root[root == root[y]] = root[x]
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    importable(multi.sparkSession)
    return inner.unionByName(outer).groupBy("key", "o", "m").applyInPandas(compare, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    sketches = stored(sketch(docs), "near-sketch")
    filled = sketches.where("n_shingles > 0 and doc_id is not null")
    classes = filled.groupBy("set_key").agg(
        F.min(F.struct("doc_id", "text_key")).alias("own"), F.any_value("n_shingles").alias("n"), F.any_value("registers").alias("registers")
    )
    # A class has a number of its own, as one doc_id may be the smallest of several.
    classes = classes.select("set_key", "own.*", "n", "registers", F.monotonically_increasing_id().alias("rep"))
    classes = stored(classes, "near-classes")
    repeated = not filled.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").isEmpty()
    rows = stored(_bands(classes), "near-bands")
    sizes = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "near-sizes")
    multi = stored(rows.join(sizes, "key"), "near-multi")

    # The class that meets most others is the hub of its bands: copies resemble their origin more than each other.
    degree = multi.groupBy("rep").agg(F.sum("size").alias("degree"))
    central = F.max(F.struct("degree", (-F.col("rep")).alias("negative")))
    hubs = multi.join(degree, "rep").groupBy("key").agg((-central["negative"]).alias("hub"))
    met = multi.join(stored(hubs, "near-hubs"), "key").where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    tested = stored(met, "near-met")
    passing = stored(_candidates(tested, classes.select("rep", "n", "registers"), threshold), "near-candidates")
    links = _confirmed(passing, classes, docs, repeated, threshold)
    if repeated:  # the texts of one document belong together
        own = filled.select("doc_id", "set_key").distinct().join(classes.select("set_key", "rep"), "set_key")
        first = own.groupBy("doc_id").agg(F.min("rep").alias("b"))
        links = links.unionByName(own.select("doc_id", F.col("rep").alias("a")).join(first, "doc_id").where("a <> b").select("a", "b"))
    links = stored(links, "near-links")
    comps = components(links)
    more = stored(_second_look(multi.select("key", "rep"), classes, comps, docs, repeated, threshold), "near-more")
    if not more.isEmpty():
        comps = components(comps.select(F.col("rep").alias("a"), F.col("component").alias("b")).unionByName(more))

    roots = comps.join(classes.select("rep", "doc_id"), "rep")
    roots = roots.unionByName(roots.select("component").distinct().join(classes.select(F.col("rep").alias("component"), "doc_id"), "component").select(F.col("component").alias("rep"), "component", "doc_id"))
    roots = stored(roots, "near-roots")
    least = roots.groupBy("component").agg(F.min("doc_id").alias("root"))
    root_of = roots.select("rep", "component").join(least, "component").select("rep", "root")
    by_class = classes.select("set_key", "rep", "doc_id").join(root_of, "rep", "left")
    by_class = stored(by_class.select("set_key", F.coalesce("root", "doc_id").alias("component")), "near-components")
    linked = F.col("n_shingles") > 0
    out = sketches.select("doc_id", "n_shingles", "set_key").join(by_class, "set_key", "left")
    component = F.when(linked & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one_of_each(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that represent their group, with all their columns; one of those that repeat a doc_id."""
    dropped = near_duplicates(docs, threshold).where("not kept").select(F.col("doc_id").alias("__doc")).distinct()
    kept = docs.join(dropped, F.col("doc_id") == F.col("__doc"), "left_anti")
    repeats = docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("__doc")).agg(F.count(F.lit(1)).alias("__rows")).where("__rows > 1").select("__doc")
    repeats = stored(repeats, "near-repeats")
    if repeats.isEmpty():
        return kept
    match = F.col("doc_id") == F.col("__doc")
    first = Window.partitionBy("doc_id", "__share").orderBy("text", "__key")
    again = kept.join(repeats, match, "left_semi").withColumn("__key", F.to_json(F.struct(*docs.columns))).withColumn("__share", F.pmod(F.xxhash64("__key"), F.lit(64)))
    again = again.withColumn("__row", F.row_number().over(first)).where("__row = 1")
    again = again.withColumn("__row", F.row_number().over(Window.partitionBy("doc_id").orderBy("text", "__key"))).where("__row = 1")
    return kept.join(repeats, match, "left_anti").unionByName(again.select(*docs.columns))
