"""Op 11: exact ranked lexical search by hashed max-sketches.

A sketch has two rows of coordinates, each with a hash of its own. A coordinate
holds the largest impact of the document's terms that hash there; a row's width
is the power of two from four times the document's distinct terms on. A query
adds, over its terms, weight times the smaller of the term's two coordinates: an
upper bound of the score, as none of them is below the term's own impact.
Documents of a block are looked up together for a batch of queries. Each query
then scores documents exactly by descending bound, and stops where the bound is
below the k-th best score so far, so no document that could enter is left out.

Two passes over the documents. The first counts documents, terms and, for the
queries' terms alone, the documents that hold them; Spark adds up the counts of
the tasks. The second sketches, bounds and scores inside the tasks; each hands
on its best k a query, which are cut to the best k first within parts of a
query's rows and then over all. Only the queries (a stated set, read in batches
of a bounded number of bytes) and their terms' counts pass through the driver.

Terms are compared by 64-bit hash (one chance in about 1e19 a pair); counts,
weights and scores are whole numbers.

Defined results: null and empty texts have no terms, so they are neither counted
nor ranked; a query without terms has no rows; each row of the queries is ranked
for itself, also if it shares an identifier; documents without an identifier
count in the statistics but are not ranked; rows that share one are ranked each;
other columns are ignored; without documents or queries the result is empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from quakehouse.llm.words import blocks, mix, texts_of

#: term bytes: 0-9, A-Z, a-z and all of non-ASCII characters; A-Z are lowered
_TERM = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_CODE = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: coordinates a distinct term; documents scored at a time for a query; bytes of query text in a batch
SPREAD, STEP, BATCH = 4, 8, 250_000
#: documents bounded at a time; cells looked up at once
SLICE, CELLS = 1024, 2_000_000
#: parts of a query's rows that are cut to k before all are
PARTS = 64


def term_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text's number, hash) of every term of some texts, in order."""
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    inside = _TERM[raw]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    new = np.flatnonzero(np.diff(at, prepend=-2) > 1)  # the last byte is none, so terms of two texts never touch
    size = np.diff(new, append=len(at))
    place = np.arange(len(at)) - np.repeat(new, size)
    power = np.cumprod(np.full(int(size.max()), _BASE, dtype=np.uint64))
    value = _CODE[_LOWER[raw[at]]] * power[place]
    return np.searchsorted(np.cumsum(sizes), at[new], side="right"), mix(np.add.reduceat(value, new))


class Postings:
    """Distinct (document, term) pairs of some texts with their counts, by document and term."""

    def __init__(self, texts: list[bytes]):
        doc, term = term_hashes(texts)
        self.terms, code = np.unique(term, return_inverse=True)
        self.keys, self.tf = np.unique(doc * len(self.terms) + code, return_counts=True)
        self.doc, self.code = np.divmod(self.keys, max(1, len(self.terms)))
        self.n = np.bincount(doc, minlength=len(texts))
        self.distinct = np.bincount(self.doc, minlength=len(texts))

    def codes(self, terms: np.ndarray) -> np.ndarray:
        """Numbers of the given terms here; -1 of those that no text holds."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def impacts_of(self, docs: np.ndarray, codes: np.ndarray, impact: np.ndarray) -> np.ndarray:
        """Exact impacts of the terms (codes) in each of the documents; 0 where a document lacks one."""
        want = docs[:, None] * len(self.terms) + codes[None, :]
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where((self.keys[at] == want) & (codes >= 0), impact[at], 0)


def impacts(tf: np.ndarray, n: np.ndarray, count: int, total: int) -> np.ndarray:
    """What a term's count in a document of n terms is worth, among ``count`` documents of ``total`` terms in all."""
    m = 10 + (90 * n.astype(np.int64) * count) // max(1, total)
    return (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 8 * m)


class Sketches:
    """Max-sketches of some documents, one after the other, each as wide as its terms need."""

    #: where a row's part of a term's hash begins
    ROWS = (np.uint64(0), np.uint64(32))

    def __init__(self, post: Postings, impact: np.ndarray):
        self.width = 1 << np.ceil(np.log2(np.maximum(SPREAD * post.distinct, 1))).astype(np.int64)
        self.first = np.cumsum(self.width) - self.width
        rising = np.argsort(impact, kind="stable")
        doc, code, impact = post.doc[rising], post.code[rising], impact[rising]
        self.rows = []
        for row in self.ROWS:
            cells = np.zeros(int(self.width.sum()), np.int32)  # an impact is at most 1,000,000
            # of terms that meet in a cell the largest comes last
            cells[self.first[doc] + (self.spots(post.terms, row)[code] & (self.width[doc] - 1))] = impact
            self.rows.append(cells)

    @staticmethod
    def spots(terms: np.ndarray, row: np.uint64) -> np.ndarray:
        return (terms >> row & np.uint64(0xFFFFFFFF)).astype(np.int64)

    def bounds(self, docs: np.ndarray, queries: Queries) -> np.ndarray:
        """Upper bound of each query's score in each document."""
        out = np.zeros((len(docs), queries.number), np.int64)
        if not len(queries.said):
            return out
        weight, first = queries.weight[queries.said], queries.first[queries.asking]
        step = max(1, CELLS // len(queries.said))
        for lo in range(0, len(docs), step):
            some = docs[lo:lo + step]
            each = np.minimum(*(cells[self.first[some][:, None] + (self.spots(queries.terms, row)[None, :] & (self.width[some][:, None] - 1))]
                                for row, cells in zip(self.ROWS, self.rows)))
            out[lo:lo + step, queries.asking] = np.add.reduceat(each[:, queries.said] * weight, first, axis=1)
        return out


class Queries:
    """A batch of queries: their distinct terms, and which of these each one asks for (once each)."""

    def __init__(self, texts: list[bytes]):
        self.number = len(texts)
        doc, term = term_hashes(texts)
        self.terms, code = np.unique(term, return_inverse=True)
        pairs = np.unique(doc * max(1, len(self.terms)) + code)
        owner, self.said = np.divmod(pairs, max(1, len(self.terms)))
        self.first = np.searchsorted(owner, np.arange(self.number + 1))
        self.asking = np.flatnonzero(np.diff(self.first))
        self.weight = np.zeros(len(self.terms), np.int64)

    def weigh(self, count: int, df: np.ndarray) -> None:
        self.weight = np.array([math.floor(1000 * math.log((2 * count + 2) / (2 * int(d) + 1))) for d in df], np.int64)

    def of(self, q: int) -> np.ndarray:
        return self.said[self.first[q]:self.first[q + 1]]


class Best:
    """A query's best k so far: score falling, document rising."""

    def __init__(self, k: int):
        self.k, self.score, self.doc = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> int:
        """No document below this score can enter."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.append(self.score, score[score > 0]), np.append(self.doc, doc[score > 0])
        keep = np.lexsort((doc, -score))[:self.k]
        self.score, self.doc = score[keep], doc[keep]


def search_block(ids: np.ndarray, texts: list[bytes], queries: Queries, best: list[Best], count: int, total: int) -> int:
    """Bring each query's best up to date with some documents; how many scores were worked out exactly."""
    post = Postings(texts)
    impact = impacts(post.tf, post.n[post.doc], count, total)
    sketches, here, scored, every = Sketches(post, impact), post.codes(queries.terms), 0, np.flatnonzero(post.n)
    for lo in range(0, len(every), SLICE):
        docs = every[lo:lo + SLICE]
        bound = sketches.bounds(docs, queries)
        for q in queries.asking.tolist():
            mine = np.flatnonzero(bound[:, q] >= best[q].least())
            mine = mine[np.argsort(-bound[mine, q], kind="stable")]
            terms = queries.of(q)
            for first in range(0, len(mine), STEP):
                some = mine[first:first + STEP]
                if bound[some[0], q] < best[q].least():
                    break
                worth = post.impacts_of(docs[some], here[terms], impact) @ queries.weight[terms]
                best[q].add(worth, ids[docs[some]])
                scored += len(some)
    return scored


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes]]]:
    for b in batches:
        for first, end in blocks(b, 1):
            yield b.column(0).slice(first, end - first), texts_of(b, 1, first, end)


def statistics(docs: DataFrame, terms: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Documents with a term, their terms, and for each of ``terms`` (rising hashes) the documents that hold it."""

    def work(batches):
        count = total = 0
        df = np.zeros(len(terms), np.int64)
        for _, texts in _blocks(batches):
            doc, term = term_hashes(texts)
            count, total = count + len(np.unique(doc)), total + len(doc)
            at = np.minimum(np.searchsorted(terms, term), max(0, len(terms) - 1))
            held = terms[at] == term if len(terms) else np.zeros(len(term), bool)
            df += np.bincount(np.unique(doc[held] * len(terms) + at[held]) % max(1, len(terms)), minlength=len(terms))[:len(terms)]
        held = np.flatnonzero(df)
        yield pa.record_batch({"what": pa.array([-2, -1, *held.tolist()], pa.int64()), "n": pa.array([count, total, *df[held].tolist()], pa.int64())})

    counts = dict(map(tuple, docs.mapInArrow(work, "what long, n long").groupBy("what").agg(F.sum("n")).collect()))
    return counts.get(-2, 0), counts.get(-1, 0), np.array([counts.get(t, 0) for t in range(len(terms))], np.int64)


def best_documents(docs: DataFrame, queries: Queries, k: int, count: int, total: int) -> DataFrame:
    """q, doc_id, score: each query's best k (docs: doc_id long, text)."""

    def work(batches):
        best = [Best(k) for _ in range(queries.number)]
        for ids, texts in _blocks(batches):
            named = pc.is_valid(ids).to_numpy(zero_copy_only=False)
            texts = [t if ok else b"" for t, ok in zip(texts, named)]
            search_block(ids.fill_null(0).to_numpy(), texts, queries, best, count, total)
        rows = [(q, d, s) for q, b in enumerate(best) for d, s in zip(b.doc.tolist(), b.score.tolist())]
        yield pa.record_batch({c: pa.array([r[i] for r in rows], pa.int64()) for i, c in enumerate(("q", "doc_id", "score"))})

    rows = docs.mapInArrow(work, "q long, doc_id long, score long").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    for by in (["q", "part"], ["q"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "doc_id"))
        rows = rows.withColumn("rank", rank).filter(F.col("rank") <= k)
    return rows.select("q", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", batch: int = BATCH) -> DataFrame:
    """item_id, rank, doc_id, score of the best k documents for each row of ``items`` (the stated queries)."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    items = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text"))
    spark, out = docs.sparkSession, None

    def answer(group: list) -> DataFrame:
        queries = Queries([(r.text or "").encode() for r in group])
        count, total, df = statistics(docs, queries.terms)
        queries.weigh(count, df)
        names = spark.createDataFrame([(q, r.item_id) for q, r in enumerate(group)], items.select(F.lit(0).cast("long").alias("q"), "item_id").schema)
        found = best_documents(docs, queries, k, count, total)
        return found.join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score")

    group, size = [], 0
    for r in items.toLocalIterator():
        group.append(r)
        size += len(r.text or "")
        if size >= batch:
            out = answer(group) if out is None else out.unionByName(answer(group))
            group, size = [], 0
    if group or out is None:
        out = answer(group) if out is None else out.unionByName(answer(group))
    return out
