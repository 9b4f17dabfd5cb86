"""Op 9: exact top-k inner products by MaxScore over shards.

Vectors are cut into shards and the stated queries into blocks; each (shard,
block) pair is one group of bounded size, so neither side is ever whole in one
task. Inside a group a query's terms are its dimensions. A term's contributions
lie between two bounds that the shard's postings give; above their lower bound
they are non-negative, as MaxScore needs. Terms are ordered by that spread. As
long as the smallest ones together cannot lift a row above the k-th best score
so far, they are non-essential: postings of the essential terms are traversed,
and the others are probed only for rows whose bound is still competitive. The
shards' best k are merged.

Defined results: vectors that are null or hold null or non-finite components,
and rows without an identifier, take no part; rows that share an identifier are
candidates each, and asked together if it is a query's (none of them is its own
candidate); shorter vectors count as padded with zeros; ties go to the smaller
identifier; a query with fewer than k candidates returns them all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

SHARD, BLOCK, PROBE, SEED = 8192, 512, 8, 256


def quantized(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """(vec_id, v): integer components floor(scale * x) of the usable vectors."""
    x = F.col(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    return (rows.filter(F.col(vec_id).isNotNull() & x.isNotNull() & finite)
            .select(F.col(vec_id).cast("long").alias("vec_id"),
                    F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long")).alias("v")))


def maxscore(ids: np.ndarray, rows: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and scores of the k best rows for one query (ties to the smaller id); ``ids`` ascend."""
    high, low = np.maximum(rows.max(0) * query, rows.min(0) * query), np.minimum(rows.max(0) * query, rows.min(0) * query)
    order = np.argsort(low - high, kind="stable")  # terms by falling spread
    spread = (high - low)[order]
    rest = np.append(np.cumsum(spread[::-1])[::-1], 0)  # what terms from here on can add
    base, terms = low.sum(), len(query)
    best = np.zeros(0, np.int64)
    score = np.zeros(0, np.int64)
    limit = None
    lowest = np.append(np.cumsum(low[order][::-1])[::-1], 0)
    for first in [0, *range(SEED, len(ids), SHARD // 4)]:
        last = SEED if first == 0 else min(first + SHARD // 4, len(ids))
        at = np.arange(first, min(last, len(ids)))
        at = at[ids[at] != own]
        # essential terms: all but the smallest that together stay below the limit
        essential = terms if limit is None else int(np.searchsorted(-rest, -(limit - base), side="left"))
        part = rows[np.ix_(at, order[:essential])] @ query[order[:essential]] if essential else np.zeros(len(at), np.int64)
        for t in range(essential, terms, PROBE):
            alive = part + lowest[t] + rest[t] >= limit
            at, part = at[alive], part[alive]
            some = order[t:t + PROBE]
            part = part + rows[np.ix_(at, some)] @ query[some]
        best, score = np.append(best, at), np.append(score, part)
        keep = np.lexsort((ids[best], -score))[:k]
        best, score = best[keep], score[keep]
        limit = int(score[-1]) if len(score) == k else None
        if len(ids) <= SEED and first == 0:
            break
    return best, score


def top_k(rows: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
          scale: int = 1024, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score for each row of ``rows`` where ``is_query`` (a condition on vec_id) holds."""
    v = quantized(rows, vec_id, vector, scale)
    n, queries = v.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    shards, blocks = max(1, -(-n // shard)), max(1, -(-queries // block))
    part = lambda m, salt: F.pmod(F.xxhash64("vec_id", "v", F.lit(salt)), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    cands = v.select(part(shards, 1).alias("shard"), every(blocks).alias("block"), "vec_id", "v")
    asked = v.filter(is_query).select(every(shards).alias("shard"), part(blocks, 2).alias("block"), F.col("vec_id").alias("query_id"), "v")
    out = "query_id long, vec_id long, score long"

    def padded(column, width: int) -> np.ndarray:
        m = np.zeros((len(column), width), np.int64)
        for i, x in enumerate(column.to_pylist()):
            m[i, :len(x)] = x
        return m

    def best(key, left: pa.Table, right: pa.Table) -> pa.Table:
        width = max([0, *(len(x) for t in (left, right) for x in t["v"].to_pylist())])
        ids = left["vec_id"].to_numpy()
        order = np.argsort(ids)
        ids, m = ids[order], padded(left["v"], width)[order]
        q, vecs, cols = right["query_id"].to_pylist(), padded(right["v"], width), ([], [], [])
        for own, x in zip(q if len(ids) else [], vecs):
            at, score = maxscore(ids, m, x, own, k)
            for c, values in zip(cols, ([own] * len(at), ids[at], score)):
                c.extend(values)
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), cols)})

    found = cands.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(best, out)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
