"""Token totals kept up to date by signed deltas.

A batch of changes (insert, delete, revise) becomes signed sums by source, language and
tokenizer version, and is committed as one folder named by its batch number. Writing goes
to a folder of its own first; the commit is one small marker row naming that folder, and
the first marker of a batch counts. A batch handed in twice, or a task retried after a
lost executor, therefore changes nothing. Totals are the sums over committed batches, and
``compact`` folds those up to a batch into one.

Defined results: null text has no tokens; null source or language is a group of its own;
totals of groups whose documents were all deleted stay as rows of 0; rows that repeat are
counted each; an empty batch commits nothing but its number; other columns don't matter.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortry.llm.common import map_batches, split_key
from cohortry.llm.tokens import VOCABULARY, word_ids
from cohortry.sources.scratch import scratch_path

KEYS = ("source", "lang", "tokenizer")
SUMS = ("n_docs", "n_tokens")
VERSION = "word_bpe_49k"
BATCHES = 4
_MARKERS = "batch bigint, folder string, marked_at timestamp, upto bigint"
_DELTAS = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"


def count_tokens(docs: DataFrame, version: str = VERSION, vocabulary: str = VOCABULARY) -> DataFrame:
    """source, lang, tokenizer, n_tokens and ``share`` (by doc_id) of every row."""

    def count(batch: pa.RecordBatch) -> dict[str, object]:
        counts = [len(ids) // 4 for ids in word_ids(vocabulary).ids_of(batch.column("text").to_pylist())]
        return {name: batch.column(name) for name in ("source", "lang", "share")} | {"n_tokens": pa.array(counts, pa.int64())}

    narrow = docs.select("source", "lang", split_key(1 << 20, "doc_id").alias("share"), "text")
    out = map_batches(narrow, count, "source string, lang string, share int, n_tokens bigint")
    return out.withColumn("tokenizer", F.lit(version))


def signed(changes: DataFrame) -> DataFrame:
    """Additive deltas of changes with columns op, source, lang, tokenizer, n_tokens, old_tokens.

    An insert adds a document and its tokens, a delete takes both away, a revision adds
    the difference of the new and the old count.
    """
    op = F.col("op")
    documents = F.when(op == "insert", 1).when(op == "delete", -1).when(op == "revise", 0)
    new, old = (F.coalesce(F.col(c), F.lit(0)) for c in ("n_tokens", "old_tokens"))
    tokens = F.when(op == "insert", new).when(op == "delete", -new).when(op == "revise", new - old)
    known = documents.isNotNull()
    checked = F.when(known, documents).otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(op, F.lit("null")))))
    return changes.groupBy(*KEYS).agg(F.sum(checked.cast("bigint")).alias("n_docs"), F.sum(tokens).cast("bigint").alias("n_tokens"))


class Rollup:
    """Committed batches under one folder of shared storage."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.spark.createDataFrame([], _MARKERS).write.mode("append").parquet(f"{self.root}/commits")

    def commits(self) -> DataFrame:
        """The marker that counts of each batch, folded ones too: they tell replays."""
        markers = self.spark.read.schema(_MARKERS).parquet(f"{self.root}/commits")
        first = Window.partitionBy("batch").orderBy("marked_at", "folder")
        return markers.withColumn("n", F.row_number().over(first)).where("n = 1").drop("n")

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Apply a batch of changes once; False if it was committed before."""
        known = self.commits().where((F.col("batch") == batch) | (F.col("upto") >= batch)).select("batch").collect()
        if any(r["batch"] == batch for r in known):
            return False
        if any(r["batch"] < 0 for r in known):
            raise ValueError(f"batch {batch} comes after a compaction of later batches")
        folder = f"deltas/{batch}-{uuid.uuid4().hex}"
        signed(changes).write.parquet(f"{self.root}/{folder}")
        self._mark(batch, folder, batch)
        return True

    def _mark(self, batch: int, folder: str, upto: int) -> None:
        row = self.spark.range(1).select(
            F.lit(batch).cast("bigint").alias("batch"), F.lit(folder).alias("folder"),
            F.current_timestamp().alias("marked_at"), F.lit(upto).cast("bigint").alias("upto"),
        )
        row.write.mode("append").parquet(f"{self.root}/commits")

    def compact(self) -> None:
        """Fold all committed batches into one folder; replays of folded batches stay without effect."""
        last = self.commits().agg(F.max("upto")).first()[0]
        if last is not None:
            folder = f"deltas/upto-{last}-{uuid.uuid4().hex}"
            self.totals().write.parquet(f"{self.root}/{folder}")
            self._mark(-1 - last, folder, last)

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens over committed batches."""
        commits = self.commits()
        folded = commits.where("batch < 0").agg(F.max("upto")).first()[0]
        if folded is not None:
            commits = commits.where((F.col("batch") > folded) | (F.col("batch") == -1 - folded))
        live = [r["folder"] for r in commits.select("folder").collect()]  # one small row per batch since the last compaction
        if not live:
            return self.spark.createDataFrame([], _DELTAS)
        deltas = self.spark.read.schema(_DELTAS).parquet(*[f"{self.root}/{f}" for f in live])
        return deltas.groupBy(*KEYS).agg(*[F.sum(s).alias(s) for s in SUMS])


def documents_rollup(docs: DataFrame, batches: int = BATCHES, root: str | None = None) -> DataFrame:
    """Totals of a whole document table after signed changes of hashed shares.

    All documents are inserted in batches, the last one handed in twice. Then a third is deleted and another third revised,
    the batches are compacted, and the same shares are inserted and revised back; a folded batch handed in again has no effect.
    """
    spark = docs.sparkSession
    rollup = Rollup(spark, root or scratch_path(spark, "token-rollup"))
    counted = count_tokens(docs).withColumn("op", F.lit("insert")).withColumn("old_tokens", F.lit(0).cast("bigint"))
    # One pass over the texts: sums per batch first, then each batch's rows as changes.
    path = scratch_path(spark, "token-changes")
    counted.withColumn("batch", F.col("share") % batches).write.partitionBy("batch").parquet(path)
    schema = "op string, share int, source string, lang string, tokenizer string, n_tokens bigint, old_tokens bigint, batch int"
    changes = spark.read.schema(schema).parquet(path) if not docs.isEmpty() else spark.createDataFrame([], schema)
    for batch in [*range(batches), batches - 1]:
        rollup.commit(batch, changes.where(F.col("batch") == batch))
    gone, revised = changes.where(F.col("share") % 3 == 1), changes.where(F.col("share") % 3 == 2).withColumn("op", F.lit("revise"))
    more = 2 * F.col("n_tokens") + 1
    rollup.commit(batches, gone.withColumn("op", F.lit("delete")))
    rollup.commit(batches + 1, revised.withColumns({"n_tokens": more, "old_tokens": F.col("n_tokens")}))
    rollup.compact()
    rollup.commit(0, changes.where(F.col("batch") == 0))
    rollup.commit(batches + 2, gone)
    rollup.commit(batches + 3, revised.withColumn("old_tokens", more))
    return rollup.totals()
