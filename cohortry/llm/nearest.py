"""Exact nearest neighbours by a block matrix join on int8 products.

Vectors are scaled to int8 one by one. A block holds the vectors of one dimension and one
hashed share, in their own type (floats stay four bytes wide); blocks are sized by bytes,
whatever the dimension. Query blocks meet candidate blocks as pairs of matrices. A query
block is eight times as large as a candidate block, and all query blocks that fit one
meet every candidate once: what is shuffled grows in proportion to the table until the
queries pass ``QUERY_BYTES``, and from there by one copy of it per ``QUERY_BYTES`` of queries.
A tile's integer
products (exact in single precision) give every inner product up to a bound known from the
quantisation errors: |x.y - sx sy qx.qy| <= |ex| |y| + |sx qx| |ey|. A pair survives when
its upper bound reaches the k-th best lower bound of its query so far; survivors are
recomputed in double precision and kept in a heap of k per query. They are recomputed
where they survive, not joined to the vectors later: of many equal or nearly equal vectors
all survive their tile, and only heaps bound what leaves it. Queries whose norm times the
largest of the candidate block can't reach their k-th score skip the tile. Each task merges
its tiles' heaps and hands on at most k rows per query; a last step merges those.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components
take no part; vectors of different dimensions aren't compared; rows that repeat a vec_id
count as one (the smallest vector); ties go to the smaller vec_id; a query with fewer
candidates gets all; an empty table gives an empty one; other columns don't matter.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortry.llm.common import importable, type_of
from cohortry.sources.scratch import stored

K = 20
EVERY = 20
# A candidate block is one record of the shuffle; a query block stays in a worker with k heap entries per row.
CANDIDATE_BYTES = 1 << 20
QUERY_BYTES = 8 << 20
# Candidate blocks of a query block are spread over at least this many tasks, if there are as many, and a task
# takes at most GROUP_BLOCKS of them. Each task hands on k rows a query.
MERGE_GROUPS = 32
GROUP_BLOCKS = 1_024
# Queries whose products with a candidate block are held at once.
TILE_ROWS = 512


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (array of float, or of double for other types), dim of the vectors that take part."""
    v = F.col("v")
    kind = "float" if type_of(vectors, "embedding") == "array<float>" else "double"
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    nonzero = F.exists(v, lambda x: x != 0)
    cast = vectors.select("vec_id", F.col("embedding").cast(f"array<{kind}>").alias("v"))
    one = cast.where(F.col("vec_id").isNotNull() & v.isNotNull() & sound & nonzero)
    return one.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))


def value_type(vectors: DataFrame) -> type:
    return np.float32 if type_of(vectors, "v") == "array<float>" else np.float64


def blocks(vectors: DataFrame, shares: int, name: str) -> DataFrame:
    """One row per block: dim, share, ids and matrix as bytes."""
    kind = value_type(vectors)

    def gather(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec_id")
        matrix = np.stack(part["v"].to_numpy()).astype(kind)
        return pd.DataFrame({
            "dim": [matrix.shape[1]], "share": [int(part["share"].iloc[0])],
            "ids": [part["vec_id"].to_numpy(np.int64).tobytes()], "matrix": [matrix.tobytes()],
        })

    shared = vectors.withColumn("share", F.pmod(F.xxhash64("vec_id"), F.lit(shares)).cast("int"))
    out = shared.groupBy("dim", "share").applyInPandas(gather, "dim int, share int, ids binary, matrix binary")
    return stored(out, name)


class Quantised:
    """A block as integers in single precision, with scales and error norms."""

    def __init__(self, ids: np.ndarray, exact: np.ndarray):
        self.ids = ids
        self.exact = exact.astype(np.float64)
        # Scaled by the largest component first, so that norms neither overflow nor vanish.
        self.unit = np.abs(self.exact).max(axis=1)
        scaled = self.exact / self.unit[:, None]
        whole = np.rint(scaled * 127)
        self.whole = whole.astype(np.int8).astype(np.float32)
        self.error = np.linalg.norm(scaled - whole / 127, axis=1)
        self.norm = np.linalg.norm(scaled, axis=1)
        self.rounded = np.linalg.norm(whole / 127, axis=1)


def slices(ids: bytes, matrix: bytes, dim: int, kind: type, rows: int | None = None) -> Iterator[Quantised]:
    """A block's rows, quantised in slices."""
    every, exact = np.frombuffer(ids, np.int64), np.frombuffer(matrix, kind).reshape(-1, dim)
    rows = rows or max(1, len(every))
    for at in range(0, len(every), rows):
        yield Quantised(every[at : at + rows], exact[at : at + rows])


def exact_products(x: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed from the first component to the last."""
    return np.cumsum(x * ys, axis=1)[:, -1]


def tile(queries: Quantised, candidates: Quantised, heaps: dict[int, list[tuple[float, int]]], k: int) -> None:
    """Push the tile's pairs that may be among the k nearest into the heaps."""
    reach = queries.norm * queries.unit * (candidates.norm * candidates.unit).max() * (1 + 1e-9)
    floors = np.array([heap[0][0] if len(heap := heaps.get(int(q), ())) == k else -np.inf for q in queries.ids])
    near = np.flatnonzero(reach >= floors)
    if not len(near):
        return
    if len(near) < len(queries.ids):
        queries = Quantised(queries.ids[near], queries.exact[near])
    approx = (queries.whole @ candidates.whole.T).astype(np.float64) / 127**2
    bound = np.outer(queries.error, candidates.norm) + np.outer(queries.rounded, candidates.error)
    bound += 1e-12 * (1 + np.outer(queries.norm, candidates.norm))
    scale = candidates.unit[None, :]
    low, high = (approx - bound) * scale, (approx + bound) * scale
    for i, query in enumerate(queries.ids):
        heap = heaps.setdefault(int(query), [])
        unit = queries.unit[i]
        others = candidates.ids != query
        floor = -np.inf
        lows = low[i][others]
        if len(lows) >= k:
            floor = np.partition(lows, len(lows) - k)[len(lows) - k] * unit
        if len(heap) == k:
            floor = max(floor, heap[0][0])
        alive = np.flatnonzero(others & (high[i] * unit >= floor))
        scores = exact_products(queries.exact[i], candidates.exact[alive])
        for j in np.lexsort((candidates.ids[alive], -scores))[:k]:
            entry = (float(scores[j]), -int(candidates.ids[alive[j]]))
            if len(heap) < k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)


def nearest(
    vectors: DataFrame, every: int = EVERY, k: int = K, query_bytes: int = QUERY_BYTES, candidate_bytes: int = CANDIDATE_BYTES
) -> DataFrame:
    """The k nearest of every query (vec_id divisible by ``every``): query_id, rank, vec_id, score."""
    good = stored(usable(vectors), "nearest-vectors")
    kind, is_query = value_type(good), F.col("vec_id") % every == 0
    width = np.dtype(kind).itemsize * F.col("dim").cast("bigint")
    size, query_size = good.agg(F.sum(width), F.sum(F.when(is_query, width))).first()
    shares = max(1, -(-(query_size or 0) // query_bytes))
    candidate_blocks = max(1, -(-(size or 0) // candidate_bytes))
    left = blocks(good.where(is_query), shares, "nearest-queries")
    right = blocks(good, candidate_blocks, "nearest-candidates")
    groups = max(min(MERGE_GROUPS, candidate_blocks), -(-candidate_blocks // GROUP_BLOCKS))
    # A query block meets each group of candidate blocks once; its heaps live through the group.
    # It comes first in the group's records, so that it reaches the worker once, not with every candidate block.
    left = left.select(
        "dim", F.col("share").alias("q"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(0).alias("side"), "ids", "matrix"
    )
    right = right.select(
        "dim", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("q"), F.pmod("share", F.lit(groups)).alias("group"),
        F.lit(1).alias("side"), "ids", "matrix",
    )
    key = ["dim", "q", "group"]
    met = left.unionByName(right).repartition(*key).sortWithinPartitions(*key, "side")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, queries = None, []
        heaps: dict[int, list[tuple[float, int]]] = {}

        def emit() -> pa.RecordBatch:
            rows = [(q, -negative, score) for q, heap in heaps.items() for score, negative in heap]
            q, c, s = zip(*rows) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int64()), pa.array(c, pa.int64()), pa.array(s, pa.float64())], names=["query_id", "vec_id", "score"]
            )

        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if block != (row["dim"], row["q"], row["group"]):
                    if heaps:
                        yield emit()
                        heaps.clear()
                    block, queries = (row["dim"], row["q"], row["group"]), []
                if row["side"] == 0:
                    queries = list(slices(row["ids"], row["matrix"], row["dim"], kind, TILE_ROWS))
                elif queries:  # a dimension may have candidates and no queries
                    for candidates in slices(row["ids"], row["matrix"], row["dim"], kind):
                        for some in queries:
                            tile(some, candidates, heaps, k)
        yield emit()

    importable(vectors.sparkSession)
    found = met.mapInArrow(best, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
