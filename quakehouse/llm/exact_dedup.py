"""Op 10: exact deduplication by a stateful stream.

A stream over the stored documents keeps, per text digest, the surviving row's
identifier, its content locator (file and row) and the number of rows seen. The
state is RocksDB on the executors' disks with its log in the shared checkpoint
folder, has no watermark and so never expires; later files continue it. Rows are
combined before they are shuffled, so a digest that a third of all rows share is
one record per task.

A digest is only a claim: the bytes of every row in a group of two or more are
then compared with the text at the group's locator. Groups that fail (two texts
with one digest) are formed again by the full text.

Defined results: null counts as the empty text, and empty texts form one group;
the row with the largest identifier stays (null identifiers last; among rows
with the same identifier the later in file order); every row comes back once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quakehouse.session import materialize, scratch_path

_ROCKS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # each state partition else reserves megabytes of disk before it holds a row
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # commits write what changed, not a copy of the state
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def sha(text: Column) -> Column:
    return F.sha2(text, 256)


def _one(path: str) -> str:
    """A glob for exactly this path: a stream can then read a folder or a single file."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def _locator() -> list[Column]:
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]


def stream_state(spark: SparkSession, path: str, doc_id: str = "doc_id", text: str = "text",
                 normalize: Callable[[Column], Column] | None = None, digest: Callable[[Column], Column] = sha,
                 checkpoint: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Run the stream over all files not seen yet; the state as (digest, keep{id, file, row}, group_size).

    ``checkpoint`` names the folder of an earlier run to continue.
    """
    schema = T.StructType([f for f in spark.read.parquet(path).schema if f.name in (doc_id, text)])
    source = spark.readStream.schema(schema)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    said = (normalize or (lambda c: c))(F.coalesce(F.col(text), F.lit("")))
    state = (source.parquet(_one(path))
             .select(digest(said).alias("digest"), F.struct(F.col(doc_id).alias("id"), *_locator()).alias("at"))
             .groupBy("digest").agg(F.max("at").alias("keep"), F.count("*").alias("group_size")))
    where = checkpoint or scratch_path(spark, "dedup_state")
    before = {k: spark.conf.get(k, None) for k in _ROCKS}
    try:
        for k, v in _ROCKS.items():
            spark.conf.set(k, v)
        state.writeStream.format("noop").outputMode("update").option("checkpointLocation", where) \
            .trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    kept = spark.read.format("statestore").option("path", where).load()
    return kept.select(F.col("key.digest").alias("digest"), F.col("value.max").alias("keep"),
                       F.col("value.count").alias("group_size"))


def rows_of(spark: SparkSession, path: str, doc_id: str, text: str, normalize, digest) -> DataFrame:
    said = (normalize or (lambda c: c))(F.coalesce(F.col(text), F.lit("")))
    return spark.read.parquet(path).select(
        F.struct(F.col(doc_id).alias("id"), *_locator()).alias("at"), said.alias("text")
    ).withColumn("digest", digest(F.col("text")))


def classes(spark: SparkSession, path: str, doc_id: str = "doc_id", text: str = "text",
            normalize: Callable[[Column], Column] | None = None, digest: Callable[[Column], Column] = sha,
            checkpoint: str | None = None, files_per_batch: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(keepers by digest, rows whose digest named two texts).

    The first has (digest, keep, group_size) for digests that name one text. The second has
    (digest, text, keep, group_size), formed by the full text; it is empty but for collisions.
    """
    state = materialize(stream_state(spark, path, doc_id, text, normalize, digest, checkpoint, files_per_batch),
                        "dedup_keepers")
    many = state.filter(F.col("group_size") > 1).select("digest", "keep")
    hits = materialize(rows_of(spark, path, doc_id, text, normalize, digest).join(many, "digest"), "dedup_hits")
    kept = hits.filter(F.col("at") == F.col("keep")).select("digest", F.col("text").alias("kept_text"))
    # written before it is made distinct, so that the join may split a digest that many rows share
    wrong = hits.join(kept, "digest").filter(F.col("text") != F.col("kept_text")).select("digest")
    wrong = materialize(wrong, "dedup_collisions").distinct()
    exact = hits.join(wrong, "digest", "left_semi").groupBy("digest", "text").agg(
        F.max("at").alias("keep"), F.count("*").alias("group_size"))
    return state.join(wrong, "digest", "left_anti"), exact


def dedup(spark: SparkSession, path: str, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row per stored row: doc_id, keep_id, group_size, kept, digest."""
    one, split = classes(spark, path, doc_id, text, **how)
    rows = rows_of(spark, path, doc_id, text, how.get("normalize"), how.get("digest", sha))
    found = rows.select("at", "digest").join(one, "digest")
    if not split.isEmpty():
        found = found.unionByName(rows.join(split, ["digest", "text"]).select(found.columns))
    return found.select(F.col("at.id").alias("doc_id"), F.col("keep.id").alias("keep_id"), "group_size",
                        (F.col("at") == F.col("keep")).alias("kept"), "digest")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` without the rows that an equal text replaces. The rows are first stored where all executors read."""
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "dedup_content")
    docs.write.parquet(path)
    one, split = classes(spark, path, doc_id, text, **how)
    stays = one.select("keep").unionByName(split.select("keep")).select(
        F.col("keep.file").alias("__file"), F.col("keep.row").alias("__row"))
    stored = spark.read.schema(docs.schema).parquet(path).select(
        "*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    return stored.join(stays, ["__file", "__row"], "left_semi").select(docs.columns)
