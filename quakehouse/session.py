"""Session helpers: a tuned local session for tests/bench and a shared scratch folder.

Operators never create sessions themselves; they take DataFrames. These helpers
exist for the entry points (tests, bench, driver contract).
"""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "quakehouse",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local session with AQE on, UTC clock and the UI off."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # fused methods above the JVM's JIT limit would run interpreted; fall back
        # to per-operator code for those stages instead
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables.

    On a cluster this is ``spark.checkpoint.dir`` (a shared filesystem path set
    by the cluster); without it we raise, as no machine's own folder is seen by the
    others. Only a local run (tests) gets a private folder under the system temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="quakehouse-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def materialize(df, name: str):
    """Cut lineage: write ``df`` as parquet under the shared checkpoint folder and read it back.

    Preferred over ``DataFrame.checkpoint()``: a checkpointed frame keeps the
    partitioning claim of the plan it came from, and with adaptive execution a
    later sort-merge join against it can pair children with different partition
    counts. A plain file scan claims nothing, so the planner shuffles as needed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished queries: Spark keeps them until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffled(df):
    """A join side that grows with the input: joined by a shuffle, never sent through the driver.

    The planner sizes a stored table by its compressed files and the share of its columns in
    use; a few columns of a wide table look small enough to broadcast at millions of rows.
    """
    return df.hint("merge")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/scratch/{name}-{uuid.uuid4().hex[:12]}"
