"""Op 13: runs (maximal periodic stretches of words) of whole texts.

A run is a stretch of consecutive words with smallest period q and at least
max(least, 2 q) words that neither neighbour extends with that period. A text
whose words repeat nowhere near enough needs no tree: in a run every word lies
in some stretch of least/2 words that occurs again q words on, so only the
maximal stretches covered by such repeats are searched, each whole and alone (a
run never leaves one). There the method is:

* Ukkonen's suffix trees of the stretch and of its reversal;
* an Euler tour of each, kept as its least string depth between consecutive
  leaves under a sparse table: the depth of two leaves' lowest common ancestor,
  which is the longest common extension of two positions, in constant time;
* the longest Lyndon word from each position, for the order of words and for its
  reverse, as the way to the next smaller suffix; each is a candidate root;
* a root and the place after it are extended to both sides; extended to twice
  its length or more, it is a run.

Every run has a Lyndon root among these, so none is missed; equal results are
one run. Time and memory grow linearly (the tables by a logarithm) with one text.

Defined results: words are maximal stretches of bytes other than 0x20 and
0x09-0x0D, compared byte by byte; null and empty texts have no runs and an empty
collapsed text; rows are judged one by one, so repeated and null identifiers
stay; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

LEAST = 12
#: bytes of collapsed text in one batch of results
BLOCK = 4_000_000
RUN = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])
_CODES = np.random.default_rng(13).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


class SuffixTree:
    """Ukkonen's tree of a list of positive integers, with the sentinel 0 at its end."""

    def __init__(self, letters: list[int]):
        s = self.letters = [*letters, 0]
        n = len(s)
        # of each node: its edge's first letter and end, its children (None: a leaf), its suffix (-1: inner)
        first, last, kids, suffix, link = [0], [0], [{}], [-1], [0]
        node = edge = length = waiting = 0
        for i, c in enumerate(s):
            waiting += 1
            inner = 0
            while waiting:
                if not length:
                    edge = i
                child = kids[node].get(s[edge])
                if child is None:
                    kids[node][s[edge]] = len(first)
                    above = node
                else:
                    at = first[child]
                    size = last[child] - at
                    if length >= size:
                        node, edge, length = child, edge + size, length - size
                        continue
                    if s[at + length] == c:
                        length += 1
                        if inner:
                            link[inner] = node
                        break
                    above = len(first)
                    kids[node][s[edge]] = above
                    first.append(at)
                    last.append(at + length)
                    kids.append({s[at + length]: child, c: above + 1})
                    suffix.append(-1)
                    link.append(0)
                    first[child] = at + length
                first.append(i)
                last.append(n)
                kids.append(None)
                suffix.append(i - waiting + 1)
                link.append(0)
                if inner:
                    link[inner] = above
                inner = above
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        self.first, self.last, self.kids, self.suffix = first, last, kids, suffix

    def tour(self, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of an Euler tour, and its least string depth between each and the one before.

        The sentinel comes first at every node; the other letters ascend, or descend if ``reverse``.
        """
        first, last, kids, suffix = self.first, self.last, self.kids, self.suffix
        order, depths = [], []
        # a node is entered with the depth of the node above, where the tour came from
        stack, least = [(0, 0)], 0
        sign = -1 if reverse else 1
        while stack:
            node, above = stack.pop()
            if above < least:
                least = above
            below = kids[node]
            if below is None:
                order.append(suffix[node])
                depths.append(least)
                least = len(first)  # from here on, what the tour climbs back to
            else:
                depth = above + last[node] - first[node]
                # the last one pushed is entered first
                if len(below) > 1:
                    stack += [(below[c], depth) for c in sorted(below, key=lambda c: c and sign * c or -1 << 62, reverse=True)]
                else:
                    stack += [(k, depth) for k in below.values()]
        return np.array(order), np.array(depths, np.int32)


class Extensions:
    """Longest common extension to the right of two positions of a list of positive integers."""

    def __init__(self, letters: list[int], tree: SuffixTree | None = None):
        order, depths = (tree or SuffixTree(letters)).tour()
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))
        self.table = [depths]
        while 2 << len(self.table) - 1 <= len(depths):
            half = 1 << len(self.table) - 1
            self.table.append(np.minimum(self.table[-1][:-half], self.table[-1][half:]))

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of different positions i and j."""
        a, b = self.rank[i], self.rank[j]
        lo, hi = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.zeros(len(lo), np.int64)
        for k, row in enumerate(self.table):
            of = np.flatnonzero(level == k)
            out[of] = np.minimum(row[lo[of]], row[hi[of] - (1 << k)])
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each place the next one of smaller value; without one, the length."""
    values, out, stack = rank.tolist(), [len(rank)] * len(rank), []
    for i, v in enumerate(values):
        while stack and values[stack[-1]] > v:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out, np.int64)


def runs_of(letters: list[int], least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period), by start and period, of the runs of a list of positive integers."""
    n = len(letters)
    if n < least:
        return np.zeros((0, 3), np.int64)
    tree = SuffixTree(letters)
    right, left = Extensions(letters, tree), Extensions(letters[::-1])
    down = np.empty(n + 1, np.int64)
    down[tree.tour(reverse=True)[0]] = np.arange(n + 1)
    found = []
    for rank in (right.rank, down):
        i = np.arange(n)
        j = next_smaller(rank[:n])
        i, j = i[j < n], j[j < n]
        after = right.common(i, j)
        before = left.common(n - i, n - j)  # position n - i of the reversal starts with the word before i
        found.append(np.stack([i - before, j + after - i + before, j - i], axis=1))
    rows = np.concatenate(found)
    rows = rows[rows[:, 1] >= np.maximum(least, 2 * rows[:, 2])]
    rows = np.unique(rows, axis=0)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def repeated_stretches(codes: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """(first, end) of the maximal stretches, of ``least`` words or more, covered by repeats of ``least`` // 2 words."""
    k = least // 2
    if len(codes) < least:
        return []
    grams = np.zeros(len(codes) - k + 1, np.uint64)
    for x in range(k):
        grams = grams * _CODES[0] + codes[x:len(codes) - k + 1 + x].astype(np.uint64) * _CODES[1]
        grams ^= grams >> np.uint64(29)
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return []
    again = np.zeros(len(grams), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    edge = np.zeros(len(codes) + 1, np.int64)
    edge[:len(grams)] += again
    edge[k:] -= again
    covered = np.concatenate(([0], np.cumsum(edge)[:-1] > 0, [0])).astype(np.int8)
    turn = np.flatnonzero(np.diff(covered))
    return [(a, b) for a, b in zip(turn[0::2].tolist(), turn[1::2].tolist()) if b - a >= least]


def periodic(text: bytes | None, least: int = LEAST) -> tuple[np.ndarray, bytes]:
    """The runs of one text, and its words without the repeats in them, joined by one space."""
    words = (text or b"").split()  # at 0x20 and 0x09-0x0D
    code = {w: i for i, w in enumerate(dict.fromkeys(words), 1)}
    codes = np.fromiter(map(code.__getitem__, words), np.int64, len(words))
    found = [np.zeros((0, 3), np.int64)]
    for a, b in repeated_stretches(codes, least) if len(code) < len(words) else []:
        found.append(runs_of(codes[a:b].tolist(), least) + [a, 0, 0])
    runs = np.concatenate(found)  # stretches ascend
    if len(runs):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
        keep = np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()
        words = [words[i] for i in keep]
    return runs, b" ".join(words)


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """doc_id, runs (array of start, length, period; by start, then period), collapsed, for every row."""
    kind = docs.schema[doc_id].dataType
    schema = StructType([StructField("doc_id", kind), StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(ids: list, runs: list, texts: list) -> pa.RecordBatch:
            flat = np.concatenate([np.zeros((0, 3), np.int64), *runs])
            ends = np.cumsum([0, *map(len, runs)])
            cells = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], names=["start", "length", "period"])
            return pa.RecordBatch.from_arrays([pa.concat_arrays(ids), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), cells),
                                               pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"])

        for b in batches:
            runs, texts, first, size = [], [], 0, 0
            for i in range(b.num_rows):
                row, said = periodic(b.column(1)[i].as_buffer().to_pybytes() if b.column(1)[i].is_valid else None, least)
                runs.append(row)
                texts.append(said)
                size += len(said) + row.nbytes
                if size > BLOCK or i + 1 == b.num_rows:
                    yield batch([b.column(0).slice(first, i + 1 - first)], runs, texts)
                    runs, texts, first, size = [], [], i + 1, 0

    return docs.select(F.col(doc_id), F.col(text).cast("string")).mapInArrow(work, schema)
