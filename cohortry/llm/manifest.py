"""Merkle manifest of a table with octopus multiproofs.

Leaves are hashes of rows; each group of rows (a language) has a binary tree over its
leaves in order, and the groups' roots have one above them. Leaves get their place by one
range sort of the narrow leaf table, so a group holding most rows spreads over all tasks.
Trees are built in tiers: a task hashes up an aligned run of ``2 ** TIER`` nodes, whose tops
are the next tier's nodes. All nodes are kept as rows (tree, level, place, digest).

Proofs are made for whole leaf partitions, runs of leaves of one tree. A partition's
octopus proof is the least set of nodes that, with its own leaves, gives the root: level
by level the siblings that the partition can't derive. Partitions list these coordinates (two
per level at most for a run), all are fetched by one join, and each partition then
derives the shared inner nodes and reads every leaf's own proof off them.

Defined results: an empty table has no tree and gives no rows; null values are hashed as
``-``; a null group comes first; rows that repeat a key are leaves of their own, ordered by
key and then by hash (a null key first); a lone leaf is its tree's root; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterable
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortry.llm.common import importable
from cohortry.sources.scratch import stored

TIER = 12
LEAVES_PER_PARTITION = 5_000
#: The tree over the groups' roots.
TOP = -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf_hash(*values: Column) -> Column:
    """Hash of a row: each value as its number of bytes, a colon and itself, or ``-``."""

    def one(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(one, values)), 256)


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add ``place``, the row's number in its group by ``order`` from 0, and ``size``, the group's rows."""
    ordered = rows.sort(F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order])
    ordered = stored(ordered.withColumn("__at", F.monotonically_increasing_id()), "manifest-sorted")
    part = F.shiftright("__at", 33)
    runs = ordered.groupBy(group, part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    before = Window.partitionBy(group).orderBy("__part")
    runs = runs.select(
        F.col(group).alias("__group"), "__part",
        (F.sum("__n").over(before) - F.col("__n") - F.col("__first")).alias("__shift"),
        F.sum("__n").over(Window.partitionBy(group)).alias("size"),
    )
    # One row per group and sorted run of rows: as many as partitions and groups.
    joined = ordered.withColumn("__run", part).join(runs, (F.col("__run") == F.col("__part")) & F.col(group).eqNullSafe(F.col("__group")))
    return joined.select(*rows.columns, (F.col("__at") + F.col("__shift")).alias("place"), "size")


def _halves(n: int) -> int:
    return (n + 1) // 2


def build_nodes(leaves: DataFrame, tier: int = TIER) -> DataFrame:
    """All nodes of all trees: tree, level, place, size, digest, from tree, place, size, digest of the leaves.

    ``size`` is the number of nodes of the tree's level.
    """
    schema = "tree bigint, level int, place bigint, size bigint, digest string"
    nodes = current = stored(leaves.selectExpr("tree", "0 as level", "place", "size", "digest"), "manifest-leaves")
    level = 0
    importable(leaves.sparkSession)

    def hash_up(run: pd.DataFrame) -> pd.DataFrame:
        run = run.sort_values("place")
        tree, size, at = int(run["tree"].iloc[0]), int(run["size"].iloc[0]), int(run["place"].iloc[0])
        digests, parts = run["digest"].tolist(), []
        for up in range(1, tier + 1):
            if size == 1:
                break
            digests = [digest(*digests[i : i + 2]) for i in range(0, len(digests), 2)]
            at, size = at // 2, _halves(size)
            places = np.arange(at, at + len(digests))
            parts.append(pd.DataFrame({"tree": tree, "level": level + up, "place": places, "size": size, "digest": digests}))
        return pd.concat(parts)

    while True:
        growing = current.where("size > 1")
        if growing.isEmpty():
            return nodes
        grown = growing.groupBy("tree", F.shiftright("place", tier).alias("run")).applyInPandas(hash_up, schema)
        grown = stored(grown, "manifest-nodes")
        nodes = nodes.unionByName(grown)
        level += tier
        current = grown.where(F.col("level") == level)


def octopus(places: Iterable[int], size: int) -> list[tuple[int, int]]:
    """The least set of nodes (level, place) that gives the root together with leaves at ``places``."""
    known, level, missing = np.unique(np.fromiter(places, np.int64)), 0, []
    while size > 1:
        siblings = np.setdiff1d(known ^ 1, known)
        missing += [(level, p) for p in siblings[siblings < size].tolist()]
        known, size, level = np.unique(known >> 1), _halves(size), level + 1
    return missing


def derive(nodes: dict[tuple[int, int], str], places: Iterable[int], size: int) -> None:
    """Add to ``nodes`` (by level and place) what leaves at ``places`` and their octopus proof give, up to the root."""
    known, level = sorted(set(places)), 0
    while size > 1:
        parents = sorted({p >> 1 for p in known})
        for p in parents:
            pair = [nodes[level, 2 * p]]
            if 2 * p + 1 < size:
                pair.append(nodes[level, 2 * p + 1])
            nodes[level + 1, p] = digest(*pair)
        known, size, level = parents, _halves(size), level + 1


def siblings(nodes: dict[tuple[int, int], str], place: int, size: int) -> list[tuple[str, bool] | None]:
    """The path's other nodes from the leaf to the root: (digest, whether it is on the right), or None for a lone node."""
    out, level = [], 0
    while size > 1:
        other = place ^ 1
        out.append((nodes[level, other], other > place) if other < size else None)
        place, size, level = place >> 1, _halves(size), level + 1
    return out


def fold(start: str, path: Iterable[tuple[str, bool] | None]) -> str:
    """The root that follows from a leaf and the siblings on its path."""
    for step in path:
        if step is None:
            start = digest(start)
        else:
            start = digest(start, step[0]) if step[1] else digest(step[0], start)
    return start


def manifest(docs: DataFrame, group: str = "lang", key: str = "doc_id", leaf: Column | None = None, extra: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(leaves, nodes). Leaves: key, tree, place, size, digest and the columns ``extra``; ``tree`` numbers the groups."""
    leaf = leaf_hash(*[F.col(c) for c in FIELDS]) if leaf is None else leaf
    extra = extra or {}
    rows = docs.select(F.col(group).alias("group"), F.col(key).alias("key"), leaf.alias("digest"), *[c.alias(n) for n, c in extra.items()])
    rows = placed(stored(rows, "manifest-rows"), "group", ["key", "digest"])
    rows = stored(rows, "manifest-placed")
    groups = rows.select("group").distinct().withColumn("one", F.lit(0))
    trees = stored(placed(groups, "one", ["group"]).select(F.col("group").alias("__group"), F.col("place").alias("tree"), F.col("size").alias("trees")), "manifest-trees")
    leaves = rows.join(trees, F.col("group").eqNullSafe(F.col("__group"))).drop("group", "__group")
    leaves = stored(leaves, "manifest-leaves")
    nodes = build_nodes(leaves)
    # A tree's root is its only node without company; a lone leaf is its own.
    roots = nodes.where("size = 1").select("tree", "digest")
    above = roots.join(trees.select("tree", F.col("trees").alias("size")), "tree")
    above = build_nodes(above.select(F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("place"), "size", "digest"))
    return leaves, stored(nodes.unionByName(above), "manifest-all-nodes")


def prove(leaves: DataFrame, nodes: DataFrame, per_partition: int = LEAVES_PER_PARTITION) -> DataFrame:
    """Every row of ``leaves`` with its proof: subroot, root, path (array of digest and side; a null digest where a node is alone).

    ``leaves`` may be any part of the manifest's leaves. A leaf partition holds the leaves given from a run of ``per_partition``.
    """
    leaves = leaves.withColumn("part", F.floor(F.col("place") / per_partition).cast("bigint"))
    narrow = leaves.select("tree", "part", "place", "size", "trees", "digest").distinct()
    key = "tree bigint, part bigint"

    def coordinates(run: pd.DataFrame) -> pd.DataFrame:
        tree, part = int(run["tree"].iloc[0]), int(run["part"].iloc[0])
        wanted = [(tree, *c) for c in octopus(run["place"], int(run["size"].iloc[0]))]
        wanted += [(TOP, *c) for c in octopus([tree], int(run["trees"].iloc[0]))]
        out = pd.DataFrame(wanted, columns=["of", "level", "at"]).astype({"of": "int64", "level": "int32", "at": "int64"})
        return out.assign(tree=tree, part=part)[["tree", "part", "of", "level", "at"]]

    importable(leaves.sparkSession)
    wanted = narrow.groupBy("tree", "part").applyInPandas(coordinates, f"{key}, of bigint, level int, at bigint")
    wanted = stored(wanted, "manifest-wanted")
    own = nodes.select(F.col("tree").alias("of"), "level", F.col("place").alias("at"), "digest")
    fetched = wanted.join(own, ["of", "level", "at"])

    def expand(run: pd.DataFrame, proof: pd.DataFrame) -> pd.DataFrame:
        columns = ["tree", "place", "subroot", "root", "path"]
        if run.empty:
            return pd.DataFrame(columns=columns)
        tree, size, trees = int(run["tree"].iloc[0]), int(run["size"].iloc[0]), int(run["trees"].iloc[0])
        known: dict[int, dict[tuple[int, int], str]] = {tree: {}, TOP: {}}
        for of, level, at, value in zip(proof["of"], proof["level"], proof["at"], proof["digest"]):
            known[of][level, at] = value
        places = run["place"].tolist()
        known[tree].update(((0, p), d) for p, d in zip(places, run["digest"]))
        derive(known[tree], places, size)
        subroot = known[tree][max(known[tree])]
        known[TOP][0, tree] = subroot
        derive(known[TOP], [tree], trees)
        upper = siblings(known[TOP], tree, trees)
        paths = [
            [{"digest": s[0], "right": s[1]} if s else {"digest": None, "right": None} for s in siblings(known[tree], p, size) + upper]
            for p in places
        ]
        return pd.DataFrame({"tree": tree, "place": places, "subroot": subroot, "root": known[TOP][max(known[TOP])], "path": paths})

    proofs = narrow.groupBy("tree", "part").cogroup(fetched.groupBy("tree", "part")).applyInPandas(
        expand, "tree bigint, place bigint, subroot string, root string, path array<struct<digest: string, right: boolean>>"
    )
    return leaves.drop("part").join(proofs, ["tree", "place"])


def fold_path(start: Column, path: Column) -> Column:
    """The root that follows from a leaf's hash and its path, as an expression."""

    def step(digest: Column, node: Column) -> Column:
        joined = F.when(node["digest"].isNull(), digest).when(node["right"], F.concat(digest, node["digest"])).otherwise(F.concat(node["digest"], digest))
        return F.sha2(joined, 256)

    return F.aggregate(path, start, step)


def path_hash(path: Column) -> Column:
    """Hash of a path's digests in order."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda node: node["digest"])), 256)


def tampered_manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, where one in seven leaves is checked as if a character had been added."""
    fields = {c: F.col(c) for c in FIELDS}
    changed = fields | {"n_chars": F.col("n_chars") + 1}
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, leaf_hash(*changed.values())).otherwise(leaf_hash(*fields.values()))
    leaves, nodes = manifest(docs, extra={"given": tampered})
    folded = fold_path(F.col("given"), F.col("path"))
    return prove(leaves, nodes).select(
        F.col("key").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", path_hash(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"),
    )
