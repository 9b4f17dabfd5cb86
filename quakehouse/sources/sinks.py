"""Sinks: staging batch append (S3) and warehouse table writes (S5), with
write-time counters (A15)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def append_batch(df: DataFrame, path: str, batch_col: str | list[str] = "LoadBatchId") -> None:
    """S3: write batches partitioned by ``batch_col`` (first = the batch); re-running a
    batch replaces only that batch's partitions (dynamic partition overwrite)."""
    cols = [batch_col] if isinstance(batch_col, str) else list(batch_col)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*cols).parquet(path))


def write_table(df: DataFrame, path: str, mode: str = "append",
                partition_by: list[str] | None = None) -> None:
    """Warehouse table write (``INSERT ... SELECT`` = append)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def observed_write(df: DataFrame, path: str, mode: str = "append",
                   partition_by: list[str] | None = None,
                   **metrics: Column) -> dict:
    """Write and return counters gathered during the same pass (no second scan)."""
    obs = Observation(f"qh_{uuid.uuid4().hex[:8]}")
    agg = {"rows": F.count(F.lit(1))}
    agg.update(metrics)
    observed = df.observe(obs, *[c.alias(n) for n, c in agg.items()])
    write_table(observed, path, mode, partition_by)
    return obs.get
