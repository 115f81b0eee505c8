"""Exact deduplication by a stream with disk-backed keyed state.

Rows pass once through a stream keyed by digest. Its state never expires, lies in RocksDB
with its checkpoint in the shared folder, and retains per digest the largest identifier,
the locator of that row and the number of rows. A lost executor or a restarted query goes
on from the last committed batch. Afterwards the full bytes of every hit (a digest seen
more than once) are compared; texts that differ under one digest are grouped by text.

Defined results: null text counts as empty; empty texts equal each other; a null doc_id is
smaller than any other; rows repeating doc_id and text are copies of each other, and
exactly one of them is kept; an empty table gives an empty one; other columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortry.llm.common import text_or_empty
from cohortry.sources.scratch import scratch_path, stored
from cohortry.sources.tables import write_table

# State on disk, and no space reserved ahead: a state partition would take megabytes for a few keys.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
FILES_PER_BATCH = 1_000
# Digests seen more than once are broadcast up to this many (some 30 MB); beyond it all
# texts go through the comparison.
MAX_BROADCAST_DIGESTS = 200_000
SHA_HEX = 64


def run_state(spark: SparkSession, path: str, schema, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Stream the digest table at ``path`` through the keyed state and read the state back.

    Returns digest, keep_id, keep_locator, group_size.
    """
    checkpoint = scratch_path(spark, "dedup-state")
    before = {name: spark.conf.get(name, None) for name in STATE}
    for name, value in STATE.items():
        spark.conf.set(name, value)
    try:
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
        keyed = rows.groupBy("digest").agg(
            F.max(F.struct("doc_id", "locator")).alias("keep"), F.count(F.lit(1)).alias("n")
        )
        query = (
            keyed.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
            .option("checkpointLocation", checkpoint).start()
        )
        query.awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    if query.lastProgress is None:  # no rows, hence no state
        return spark.createDataFrame([], f"digest string, keep_id {schema['doc_id'].dataType.simpleString()}, keep_locator bigint, group_size bigint")
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(
        F.col("key.digest").alias("digest"),
        F.col("value.max.doc_id").alias("keep_id"),
        F.col("value.max.locator").alias("keep_locator"),
        F.col("value.count").alias("group_size"),
    )


def _collisions(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """Digests under which different texts lie. Copies shrink to two texts in every task."""
    hits = groups.where("group_size > 1").select("digest")
    if hits.count() <= MAX_BROADCAST_DIGESTS:
        texts = texts.join(F.broadcast(hits), "digest", "left_semi")
    ends = texts.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high"))
    return ends.where("low <> high").select("digest")


def exact_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest_letters: int = SHA_HEX,
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``digest_letters`` shortens the key of the state; results don't depend on it.
    """
    spark = docs.sparkSession
    text = text_or_empty(text_column)
    full = docs.select(F.col(id_column).alias("doc_id"), text.alias("text")).withColumn("text_sha256", F.sha2("text", 256))
    full = full.withColumn("digest", F.substring("text_sha256", 1, digest_letters))
    path = scratch_path(spark, "dedup-digests")
    narrow = full.select("doc_id", "text_sha256", "digest", F.monotonically_increasing_id().alias("locator"))
    write_table(narrow, path)
    rows = spark.read.schema(narrow.schema).parquet(path)
    groups = stored(run_state(spark, path, narrow.schema, files_per_batch), "dedup-groups")

    collided = stored(_collisions(full.select("digest", "text"), groups), "dedup-collided")
    found = ["doc_id", "keep_id", "group_size", (F.col("locator") == F.col("keep_locator")).alias("kept"), "text_sha256"]
    out = rows.join(groups, "digest")
    if collided.isEmpty():
        return out.select(*found)
    # Under a shared digest the full texts decide; they differ in their full digest as well.
    sound = out.join(collided, "digest", "left_anti").select(*found)
    mixed = rows.join(collided, "digest", "left_semi")
    texts = mixed.groupBy("digest", "text_sha256").agg(
        F.max(F.struct("doc_id", "locator")).alias("keep"), F.count(F.lit(1)).alias("group_size")
    ).select("digest", "text_sha256", F.col("keep.doc_id").alias("keep_id"), F.col("keep.locator").alias("keep_locator"), "group_size")
    return sound.unionByName(mixed.join(texts, ["digest", "text_sha256"]).select(*found))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = exact_groups(docs).where("kept")
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"))
    kept = kept.select(F.concat(key, "text_sha256").alias("__key")).distinct()
    marked = docs.withColumn("__key", F.concat(key, F.sha2(text_or_empty(), 256)))
    first = F.row_number().over(Window.partitionBy("__key").orderBy("__key"))
    return (
        marked.join(kept, "__key", "left_semi").withColumn("__row", first).where("__row = 1").select(*docs.columns)
    )
