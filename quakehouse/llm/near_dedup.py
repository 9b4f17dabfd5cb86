"""Op 7: near duplicates by bottom-k sketches from one hash function.

1. A text's set is its distinct word shingles; its sketch the k smallest hashes.
   Texts with equal sets (a 128-bit digest of the whole set) are one class.
2. Inverted lists say which classes overlap. A vocabulary of a few thousand words
   gives any two long texts some shingle in common, so a list is kept for ``r``
   retained values in a row, not for one. Of two sets with Jaccard similarity 0.8, each
   of the union's k smallest values is in both with probability 0.8, and values in a
   row of the union that both hold stand in a row in both sketches: of 64, no three in
   a row are shared with a chance under 1e-9 (``run_length``). Sets with at most k
   shingles are their own sketch; there ``short_runs`` names the sizes for which fewer
   in a row are all that is sure, and lists these too, so none of them is missed.
3. Lists are compared by pivots (``linking``), between sets whose sizes allow the
   similarity; a pair's union sketch must show the overlap; then the Jaccard
   similarity of the full sets decides.
4. Components of the links; the smallest doc_id of each stays.

Defined results: null, empty or blank texts have an empty set and are linked with
nothing; rows with a null doc_id are returned, unlinked, with a null component_id
and kept; rows that share a doc_id are one node.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quakehouse.llm import linking
from quakehouse.llm.words import Words, blocks, shingle_set, texts_of
from quakehouse.session import materialize

K, SHINGLE, PERCENT = 64, 2, 80


def run_length(k: int = K, percent: int = PERCENT, missed: float = 1e-9) -> int:
    """The greatest r for which near duplicates' sketches share no r of k union values in a row with a chance under ``missed``."""
    p, r = percent / 100, 1
    while True:
        # none[j]: the chance that j values hold no r + 1 shared ones in a row
        none = [1.0] * (r + 1)
        for j in range(r + 1, k + 1):
            none.append(sum(p ** i * (1 - p) * none[j - i - 1] for i in range(r + 1)))
        if none[k] >= missed:
            return r
        r += 1


def short_runs(k: int = K, percent: int = PERCENT) -> dict[int, list[int]]:
    """{length: set sizes}: runs under ``run_length`` that sets of these sizes are listed under too.

    A union of u <= k values with s shared ones is cut by u - s others, so s / (u - s + 1) in a row are sure.
    """
    out: dict[int, set[int]] = {}
    for u in range(1, k + 1):
        shared = math.ceil(u * percent / 100)
        sure = math.ceil(shared / (u - shared + 1))
        if shared < u and sure < run_length(k, percent):
            out.setdefault(sure, set()).update(range(shared, u + 1))
    return {r: sorted(n) for r, n in sorted(out.items())}


def run_keys(sketch: str, size: str, k: int = K, percent: int = PERCENT) -> Column:
    """The list keys of a sketch: a hash of each run of its values."""
    def runs(r: int) -> Column:
        first = F.slice(sketch, 1, F.greatest(F.size(sketch) - (r - 1), F.lit(0)))
        return F.transform(first, lambda v, i: F.xxhash64(*[F.get(sketch, i + j) for j in range(r)]))

    keys = runs(run_length(k, percent))
    for r, sizes in short_runs(k, percent).items():
        keys = F.when(F.col(size).isin(sizes), F.concat(keys, runs(r))).otherwise(keys)
    return keys


def sketches(docs: DataFrame, n: int = SHINGLE, k: int = K, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, class (digest of the set; null if empty) and sketch, one row per document."""
    out = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("n_shingles", T.LongType()),
                        T.StructField("class", T.BinaryType()), T.StructField("sketch", T.ArrayType(T.LongType()))])

    def run(batches):
        for b in batches:
            for first, end in blocks(b, 1):
                w = Words(texts_of(b, 1, first, end))
                grams, rows = w.shingles(n), []
                for i in range(end - first):
                    s = shingle_set(w.hash[w.of(i)], grams[w.of(i)], n)
                    rows.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None,
                                 s[:k].view(np.int64)))
                sizes, names, values = zip(*rows)
                ends = np.cumsum([0, *map(len, values)])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, end - first), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values), pa.int64()))],
                    out.names)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, out)


def full_sets(docs: DataFrame, nodes: DataFrame, n: int, doc_id: str, text: str) -> DataFrame:
    """(node, set) of the classes in ``nodes`` (node = doc_id): sorted 64-bit shingle hashes."""
    out = T.StructType([T.StructField("node", T.LongType()), T.StructField("set", T.BinaryType())])

    def run(batches):
        for b in batches:
            for first, end in blocks(b, 1):
                w = Words(texts_of(b, 1, first, end))
                grams = w.shingles(n)
                got = [shingle_set(w.hash[w.of(i)], grams[w.of(i)], n).tobytes() for i in range(end - first)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, end - first), pa.array(got, pa.binary())], out.names)

    return (docs.select(F.col(doc_id).cast("long").alias("node"), F.col(text).alias("text"))
            .join(nodes, "node", "left_semi").mapInArrow(run, out))


def compared(pairs: DataFrame, left: str, right: str, test, carry: list[str]) -> DataFrame:
    """Rows of ``pairs`` for which ``test`` of the Arrow columns left and right holds."""
    schema = T.StructType([pairs.schema[c] for c in carry])

    def run(batches):
        for b in batches:
            x, y = (b.column(b.schema.get_field_index(c)) for c in (left, right))
            yield b.select(carry).filter(pa.array(test(x, y), pa.bool_()))

    return pairs.select(*carry, left, right).mapInArrow(run, schema)


def close(percent: int, kind=np.uint64):
    """Test of full sets (sorted, binary). With the values' first bits only, as ``kind``, none that is close is missed."""
    def one(x: bytes, y: bytes) -> bool:
        if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
            return False
        both = np.frombuffer(x + y, kind)
        both = np.sort(both, kind="stable")  # merges the two sorted runs
        shared = int(np.count_nonzero(both[1:] == both[:-1]))
        return 100 * shared >= percent * (len(both) - shared) > 0

    return lambda x, y: [one(p, q) for p, q in zip(x.to_pylist(), y.to_pylist())]


def plausible(k: int, percent: int):
    """Test of sketches' upper halves: the union's k smallest must show the overlap that near duplicates have.

    Halves keep the order of the values; two that fall together only raise the overlap, so no pair is missed.
    """
    none = 2**40  # fills up sketches of fewer than k values

    def table(x: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.diff(x.offsets.to_numpy())
        out = np.full((len(x), k), none, np.int64)
        out[np.arange(k) < sizes[:, None]] = x.flatten().to_numpy().view(np.uint32)
        return out, sizes

    def test(x: pa.ListArray, y: pa.ListArray) -> np.ndarray:
        (p, m), (q, n) = table(x), table(y)
        both = np.concatenate((p, q), axis=1)
        both.sort(axis=1)
        same = both[:, 1:] == both[:, :-1]
        twice = same & (both[:, 1:] != none)
        rank = 1 + np.cumsum(~same, axis=1, dtype=np.int16)  # place of a value in the union
        whole = twice.sum(axis=1)
        least = (twice & (rank <= k)).sum(axis=1) >= int(0.4 * k * percent / 80)
        return np.where((m < k) & (n < k), 100 * whole >= percent * (m + n - whole), least)
    return test


def near_duplicates(docs: DataFrame, n: int = SHINGLE, k: int = K, percent: int = PERCENT, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    told = materialize(sketches(docs, n, k, doc_id, text), "sketches")
    usable = told.filter(F.col("class").isNotNull() & F.col("doc_id").isNotNull())
    named = usable.groupBy("class").agg(F.min(F.col("doc_id").cast("long")).alias("node"))
    nodes = materialize(
        usable.select("class", "doc_id", "n_shingles", "sketch").join(named, "class")
        .filter(F.col("doc_id") == F.col("node")).dropDuplicates(["class"])
        .select("node", "n_shingles", "sketch",
                F.transform("sketch", lambda v: F.shiftright(v, 32).cast("int")).alias("halves")), "classes")
    listed = nodes.select("node", F.col("n_shingles").alias("size"), F.explode(run_keys("sketch", "n_shingles", k, percent)).alias("key"))
    often = listed.groupBy("key").count().filter("count > 1").select("key")  # a sketch's runs differ, so these are of two classes
    lists = materialize(listed.join(often, "key").select("key", "node", "size"), "lists")

    known: list[DataFrame] = []  # the full sets read so far, (node, set)

    def links(pairs: DataFrame) -> DataFrame:
        def of(end: str, *columns: str) -> DataFrame:
            return nodes.select(F.col("node").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns])

        drawn = pairs.join(of("a", "halves"), "a").join(of("b", "halves"), "b")
        likely = materialize(compared(drawn, "halves_a", "halves_b", plausible(k, percent), ["a", "b"]), "likely")
        ids = likely.select(F.col("a").alias("node")).unionByName(likely.select(F.col("b").alias("node"))).distinct()
        for have in known:
            ids = ids.join(have.select("node"), "node", "left_anti")
        # written, so that later rounds' few ids are broadcast if the planner finds them small, and texts stay in place
        known.append(materialize(full_sets(docs, materialize(ids, "set_ids"), n, doc_id, text), "sets"))
        sets = known[0]
        for have in known[1:]:
            sets = sets.unionByName(have)
        both = (likely.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
                .join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b"))
        return compared(both, "sa", "sb", close(percent), ["a", "b"]).distinct()

    parts = linking.components(linking.resolve(lists, links, percent=percent, shared=True))
    of_class = named.join(parts, "node", "left").select("class", F.coalesce("component", "node").alias("component_id"))
    return (told.join(of_class, "class", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", F.col("doc_id").cast("long"))).alias("component_id"))
            .withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))))


def keep_one(docs: DataFrame, n: int = 5, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component."""
    out = near_duplicates(docs, n, K, percent, doc_id, text).filter(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(materialize(out, "near_gone"), F.col(doc_id) == F.col("__gone"), "left_anti").select(docs.columns)
