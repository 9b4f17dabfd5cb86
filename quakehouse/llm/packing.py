"""Op 5: packing documents into fixed-length sequences by cutting-stock column generation.

1. Every document is encoded once; each piece (full sequences first, then the
   remainder) keeps its place, length and the CRC of its ids. Texts don't move.
2. Lengths are counted in classes of ``grain`` tokens. The histogram has at most
   ``size / grain`` rows, whatever the input's size, so it goes to the driver.
3. A linear program over patterns (how many pieces of each class share a
   sequence) is solved by column generation: its duals price the classes and a
   knapsack dynamic program finds the next pattern.
4. The solution is rounded to whole sequences; classes it leaves over are packed
   best-fit. The patterns (a bounded table) are broadcast; pieces, ranked within
   their class, take the patterns' places in order. Ranks come from counts by
   (class, salt), so a class with a third of all rows is spread over many tasks.

Defined results: a null text is empty and has only the closing id; rows that
repeat are packed each; an empty table gives no rows. Each id is in exactly one
piece, a sequence's offsets are gapless from 0, and no sequence exceeds ``size``.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from quakehouse.llm import bpe
from quakehouse.session import materialize

SIZE, GRAIN, END = 2048, 8, 1
#: share of sequences above the proven bound at which the linear program stops
GAP = 3e-3


def pieces(docs: DataFrame, path: str, size: int = SIZE, end: int = END, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens."""
    key = docs.schema[doc_id].dataType
    out = T.StructType([T.StructField("doc_id", key)] + [
        T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")])
    close = np.array([end], "<u4").tobytes()

    def run(batches):
        model = bpe.model(path)
        for whole in batches:
            for b in bpe.slices(whole, "text"):
                row, rest = [], []
                flat, ends = model.encode(b.column(1))
                for i, (first, last) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
                    n = last - first + 1
                    for s in range(0, n, size):
                        length = min(size, n - s)
                        crc = zlib.crc32(flat[first + s:min(first + s + length, last)])
                        row.append(i)
                        rest.append((s, length, zlib.crc32(close, crc) if s + length == n else crc, n))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row, pa.int64()))]
                    + [pa.array(c, pa.int64()) for c in zip(*rest)], out.names)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, out)


def knapsack(price: np.ndarray, weight: np.ndarray, room: int) -> tuple[float, dict[int, int]]:
    """The best value of items (each any number of times) in ``room``, and how many of each."""
    best, took = np.zeros(room + 1), np.full(room + 1, -1)
    fitting = np.searchsorted(weight, np.arange(room + 1), side="right")  # weights ascend
    for j in range(1, room + 1):
        m, most = fitting[j], best[j - 1]
        if m:
            value = best[j - weight[:m]] + price[:m]
            k = value.argmax()
            if value[k] > most + 1e-12:
                most, took[j] = value[k], k
        best[j] = most
    counts: Counter[int] = Counter()
    j = room
    while j > 0:
        if took[j] < 0:
            j -= 1
        else:
            counts[int(took[j])] += 1
            j -= int(weight[took[j]])
    return float(best[room]), dict(counts)


def inverted(matrix: np.ndarray) -> np.ndarray:
    """The inverse by Gauss-Jordan steps (threaded library routines can stall beside other busy threads)."""
    n = len(matrix)
    both = np.hstack((matrix, np.eye(n)))
    for i in range(n):
        k = i + int(np.abs(both[i:, i]).argmax())
        both[[i, k]] = both[[k, i]]
        both[i] /= both[i, i]
        factor = both[:, i].copy()
        factor[i] = 0
        both -= factor[:, None] * both[i]
    return both[:, n:]


def product(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    return (matrix * vector).sum(axis=1)


def solve(demand: dict[int, int], room: int, gap: float = GAP, rounds: int = 40) -> list[tuple[dict[int, int], float]]:
    """Patterns {class: pieces} with the (fractional) number of sequences of each, by column generation.

    It stops when the patterns need at most ``gap`` more sequences than the bound that the duals
    prove, or after ``rounds`` columns per class; a basis is feasible after any of them.
    """
    classes = np.array(sorted(demand), dtype=np.int64)
    n = len(classes)
    need = np.array([demand[int(c)] for c in classes], dtype=float)
    basis = [{i: room // int(c)} for i, c in enumerate(classes)]
    inverse = np.diag(1.0 / np.array([room // c for c in classes], dtype=float)) if n else np.zeros((0, 0))
    x = product(inverse, need)
    bound = float((classes * need).sum()) / room
    for step in range(rounds * n):
        price = inverse.sum(axis=0)
        value, counts = knapsack(np.maximum(price, 0), classes, room)
        bound = max(bound, float((np.maximum(price, 0) * need).sum()) / max(value, 1.0))
        if value <= 1 + 1e-7 or x.sum() <= bound * (1 + gap):
            break
        column = np.zeros(n)
        for i, k in counts.items():
            column[i] = k
        turn = product(inverse, column)
        able = np.flatnonzero(turn > 1e-9)
        ratio = x[able] / turn[able]
        out = int(able[ratio.argmin()])
        basis[out] = counts
        if step % 200 == 199:
            matrix = np.zeros((n, n))
            for j, c in enumerate(basis):
                for i, k in c.items():
                    matrix[i, j] = k
            inverse = inverted(matrix)
        else:
            pivot = inverse[out] / turn[out]
            inverse -= np.outer(turn, pivot)
            inverse[out] = pivot
        x = np.maximum(product(inverse, need), 0)
    return [({int(classes[i]): k for i, k in c.items()}, float(v)) for c, v in zip(basis, x)]


def plan(histogram: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """Whole patterns: (pieces by class, sequences) that take each piece of the histogram exactly once."""
    left, used = Counter(histogram), Counter()
    out: list[tuple[dict[int, int], int]] = []
    if left.get(room):
        out.append(({room: 1}, left.pop(room)))
    def use(pattern: dict[int, int], times: int) -> None:
        if times > 0:
            used[tuple(sorted(pattern.items()))] += times
            for c, k in pattern.items():
                left[c] -= k * times

    found = solve(dict(left), room)
    for pattern, v in found:
        use(pattern, min([math.floor(v + 1e-6), *(left[c] // k for c, k in pattern.items())]))
    for pattern, v in sorted(found, key=lambda p: math.floor(p[1] + 1e-6) - p[1]):
        if v % 1 > 1e-6 and all(left[c] >= k for c, k in pattern.items()):
            use(pattern, 1)
    while rest := sorted((c for c, k in left.items() if k), reverse=True):  # what rounding leaves, largest first
        pattern: Counter[int] = Counter()
        space = room
        for c in rest:
            k = min(space // c, left[c])
            if k:
                pattern[c] = k
                space -= k * c
        use(dict(pattern), min(left[c] // k for c, k in pattern.items()))
    return out + [(dict(p), k) for p, k in sorted(used.items())]


def pack(docs: DataFrame, path: str, size: int = SIZE, grain: int = GRAIN, end: int = END,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of ``docs`` with sequence_id and offset; see the module's text."""
    spark = docs.sparkSession
    room = size // grain
    cut = materialize(pieces(docs, path, size, end, doc_id, text), "pack_pieces")
    cut = cut.withColumn("class", F.ceil(F.col("length") / grain).cast("int"))
    histogram = {r["class"]: r["n"] for r in cut.groupBy("class").agg(F.count("*").alias("n")).collect()}
    slots, first, sequence = [], Counter(), 0
    for p, (pattern, times) in enumerate(plan(histogram, room)):
        for c, k in sorted(pattern.items(), reverse=True):
            slots.append((c, first[c], first[c] + k * times, k, sequence))
            first[c] += k * times
        sequence += times
    places = spark.createDataFrame(slots, "class int, first long, last long, per long, base long")
    # salts grow as the square root of the input: both the groups and the list of their counts stay small
    salts = max(16, math.isqrt(sum(histogram.values())))
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)).cast("int"))
    counts = salted.groupBy("class", "salt").agg(F.count("*").alias("n"))
    before = counts.select("class", "salt", (F.sum("n").over(
        Window.partitionBy("class").orderBy("salt").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("ahead"))
    order = Window.partitionBy("class", "salt").orderBy("doc_id", "start", "doc_tokens", "ids_crc32")
    ranked = (salted.withColumn("at", F.row_number().over(order) - 1).join(before, ["class", "salt"])
              .withColumn("rank", F.col("at") + F.col("ahead")))
    p, q = ranked.alias("p"), F.broadcast(places).alias("q")
    placed = p.join(q, (F.col("p.class") == F.col("q.class")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
    seated = placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("p.class").alias("class"), "rank",
                           (F.col("base") + F.floor((F.col("rank") - F.col("first")) / F.col("per"))).alias("sequence_id"))
    within = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "rank").rowsBetween(Window.unboundedPreceding, 0)
    return seated.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         (F.sum("length").over(within) - F.col("length")).alias("offset"))
