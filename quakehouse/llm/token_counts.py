"""Op 3: token counts of fields and sections by offset mapping.

A document's fields are written one after the other, a line feed between them,
and the whole is encoded once with a byte-level BPE, so tokens are the ones a
model would see. Each token's span follows from the lengths of the vocabulary's
byte strings. Sections (each field, and each line of the text) are spans too, and
an interval join of the two sorted lists counts the tokens of each section.

A token that crosses a boundary goes, by ``rule``:
  most    to the section that holds most of its bytes, the earlier one of equals;
  first   to the section that holds its first byte.
The line feed after a section belongs to it. Every token is counted exactly once.

Defined results: null fields are empty; a section without tokens counts 0; rows
that repeat are counted each; an empty table gives no rows.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from quakehouse.llm.bpe import slices

_CODERS: dict[str, tuple] = {}


def coder(path: str, pattern: str):
    """(encoder, byte length of each id) of a rank file; one per worker process."""
    if path not in _CODERS:
        import tiktoken

        with open(path, "rb") as fh:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, fh)}
        lens = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            lens[i] = len(token)
        _CODERS[path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lens
    return _CODERS[path]


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str = "most") -> tuple[np.ndarray, np.ndarray]:
    """Tokens, and crossing tokens, counted for each section; sections begin at ``bounds`` (ascending, from 0)."""
    first = np.searchsorted(bounds, starts, side="right") - 1
    last = np.searchsorted(bounds, ends - 1, side="right") - 1
    owner, over = first.copy(), np.flatnonzero(last > first)
    if rule == "most":
        edges = np.append(bounds, np.iinfo(np.int64).max)
        for i in over:
            parts = np.arange(first[i], last[i] + 1)
            held = np.minimum(edges[parts + 1], ends[i]) - np.maximum(edges[parts], starts[i])
            owner[i] = parts[held.argmax()]
    n = len(bounds)
    return np.bincount(owner, minlength=n), np.bincount(owner[over], minlength=n)


def count_tokens(docs: DataFrame, path: str, pattern: str, fields: tuple[str, ...] = ("source", "lang"),
                 text: str = "text", doc_id: str = "doc_id", rule: str = "most") -> DataFrame:
    """One row per section: doc_id, section, name, start, end (characters), n_tokens, n_crossing, doc_tokens."""
    out = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("section", T.IntegerType()),
                        T.StructField("name", T.StringType())] + [
        T.StructField(n, T.LongType()) for n in ("start", "end", "n_tokens", "n_crossing", "doc_tokens")])

    def run(batches):
        encoder, lens = coder(path, pattern)
        for whole in batches:
            for b in slices(whole, "text"):
                row, name, cols = [], [], [[] for _ in range(6)]
                for i, (body, *heads) in enumerate(zip(*(b.column(j + 1).to_pylist() for j in range(len(fields) + 1)))):
                    lines = (body or "").split("\n")
                    parts = [h or "" for h in heads] + lines
                    ids = np.array(encoder.encode_ordinary("\n".join(parts)), np.int64)
                    ends = np.cumsum(lens[ids])
                    sizes = np.array([len(p.encode()) + 1 for p in parts])
                    held, crossing = attribute(ends - lens[ids], ends, np.cumsum(sizes) - sizes, rule)
                    chars = np.array([len(p) for p in parts])
                    start = np.cumsum(chars + 1) - chars - 1
                    row += [i] * len(parts)
                    name += [*fields, *["text"] * len(lines)]
                    for c, values in zip(cols, (range(len(parts)), start, start + chars, held, crossing, [len(ids)] * len(parts))):
                        c.extend(values)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row, pa.int64())), pa.array(cols[0], pa.int32()), pa.array(name, pa.string())]
                    + [pa.array(c, pa.int64()) for c in cols[1:]], out.names)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       *[F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(fields)]).mapInArrow(run, out)
