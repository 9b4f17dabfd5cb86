"""K1/K2: dense surrogate keys without a single-partition window, and ids that stay.

``row_number() over (order by k)`` moves every row into one task. Instead:

1. take the (unique) order key alone, range-partition and sort it with Spark's own
   range partitioner (sampled bounds, binary search per row, any number of
   partitions);
2. tag each key with its partition id and its position in the partition
   (``monotonically_increasing_id`` = partition << 33 | position);
3. write that once as a table in the shared checkpoint folder and read it back:
   range sampling is not repeatable, so counts and keys must come from the same
   stored rows (this also cuts lineage: a lost executor re-reads them). Its size is
   that of the order key, whatever the rows hold;
4. count rows per partition (one row per partition) and add up the counts;
5. key = start + offset(partition) + position + 1, joined back to the rows by the
   order key (rows that hold nothing else need no join; ``whole`` rows are sorted and
   stored themselves, which is cheaper than the join if they hold little else).

The result equals ``start + row_number() over (order by keys)`` exactly when
the order key is unique (NULLs first, like Spark's ascending order).

Such numbers depend on what else is numbered, so a second run over the same rows
could number them anew. :func:`stable_keys` looks them up in a stored registry
(business key -> id) first and numbers only what is not in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quakehouse.session import materialize, shuffled


def assign_keys(df: DataFrame, order_by: list[str], name: str = "key",
                start: int | Column = 0, buckets: int | None = None, whole: bool = False) -> DataFrame:
    """Add ``name`` = start + dense rank of the unique ``order_by`` tuple (1-based).

    ``whole``: number the rows where they are sorted, for rows that hold little beside the order
    key. Rows that share an order key get each of its numbers, as they do by the join.
    """
    start_col = start if isinstance(start, Column) else F.lit(start)
    order = [F.col(c).asc_nulls_first() for c in order_by]
    narrow = df if whole else df.select(*order_by)
    # without an explicit count, AQE may coalesce adjacent ranges (order is kept)
    ranged = narrow.repartitionByRange(max(1, buckets), *order) if buckets else narrow.repartitionByRange(*order)
    tagged = (ranged.sortWithinPartitions(*order)
              .withColumn("__qh_pid", F.spark_partition_id())
              .withColumn("__qh_pos", F.monotonically_increasing_id()))
    if whole:
        # the rows of a key lie side by side, in the order the window asks for: no shuffle, no sort
        same_key = Window.partitionBy(*order_by)
        first, last = F.col("__qh_first"), F.col("__qh_last")
        tagged = (tagged.withColumns({"__qh_first": F.min("__qh_pos").over(same_key), "__qh_last": F.max("__qh_pos").over(same_key)})
                  .withColumn("__qh_pos", F.explode(F.sequence(first, last))).drop("__qh_first", "__qh_last"))
    tagged = materialize(tagged, "dense_keys")
    # one row per partition reaches the driver
    rows = F.max(F.col("__qh_pos") - F.shiftleft(F.col("__qh_pid").cast("bigint"), 33)) + 1
    counts = sorted(tuple(r) for r in tagged.groupBy("__qh_pid").agg(rows).collect())
    before, offsets = 0, []
    for pid, n in counts:
        offsets.append((pid, before))
        before += n
    offsets = df.sparkSession.createDataFrame(offsets, "__qh_pid int, __qh_off long")
    pos = F.col("__qh_pos") - F.shiftleft(F.col("__qh_pid").cast("bigint"), 33)
    keyed = (tagged.join(F.broadcast(offsets), "__qh_pid")
             .withColumn(name, (start_col + F.col("__qh_off") + pos + 1).cast("bigint"))
             .drop("__qh_pid", "__qh_pos", "__qh_off"))
    if whole or set(df.columns) == set(order_by):
        return keyed.select(*df.columns, name)
    mine = {c: f"__qh_k{i}" for i, c in enumerate(order_by)}
    keyed = keyed.withColumnsRenamed(mine)
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in mine.items()]
    return df.join(shuffled(keyed), same).select(*[df[c] for c in df.columns], name)


def next_key_start(existing: DataFrame, key: str) -> Column:
    """Scalar column: current max key (0 when empty), for keys continuing a sequence."""
    return existing.select(F.coalesce(F.max(F.col(key)), F.lit(0)).cast("bigint")).scalar()


def content_key(columns: list[str], within: Column) -> Column:
    """Business key of a row that has none: its content, within a batch."""
    said = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return F.concat(F.lit("row "), within.cast("string"), F.lit(" "), F.sha2(said, 256))


def numbered_within(df: DataFrame, key: str, order_by: list[str], name: str = "nth") -> DataFrame:
    """Number (from 0) the rows of each ``key`` in the order of ``order_by`` (with it, unique).

    Keys are numbered over ranges of (key, order), so the rows of a hot key are never gathered.
    """
    ranked = assign_keys(df, [key, *order_by], name="__qh_rank")
    least = ranked.groupBy(key).agg(F.min("__qh_rank").alias("__qh_least"))
    return (ranked.join(shuffled(least), key).withColumn(name, F.col("__qh_rank") - F.col("__qh_least"))
            .select(*df.columns, name))


def stable_keys(df: DataFrame, registry: DataFrame | None, key: list[str], order_by: list[str],
                name: str = "StgId") -> tuple[DataFrame, DataFrame]:
    """K2: (rows with ``name``, registry rows to add); the registry holds ``key`` (unique) and ``name``.

    Rows whose key the registry knows keep its id; the others are numbered after its greatest,
    in the order of ``order_by`` and the key.
    """
    new, start = df, 0
    if registry is not None:
        ids = registry.select(*key, name)
        new, start = df.join(shuffled(ids), key, "left_anti"), next_key_start(ids, name)
    # ids once given out must not change when a later step is computed again
    added = materialize(assign_keys(new.select(*dict.fromkeys([*order_by, *key])), [*order_by, *[k for k in key if k not in order_by]],
                                    name=name, start=start).select(*key, name), "stable_keys")
    ids = added if registry is None else registry.select(*key, name).unionByName(added)
    return df.join(shuffled(ids), key).select(*df.columns, name), added
