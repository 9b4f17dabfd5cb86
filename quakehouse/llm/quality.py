"""Op 1: quality classification by co-training two views.

* content view: hashed words and character-class shares of the whole text;
* metadata view: source, language, size and layout (lines, their lengths, marks).

Both are logistic regressions, trained on a documented, bounded sample:
``LABELED`` labelled and ``POOL`` unlabelled documents (smallest hash of the
identifier first). In each of ``ROUNDS`` rounds every view labels the unlabelled
documents it is surest of, in the classes' proportions, and hands them to the
other. Each view is then calibrated (Platt) on labelled documents that neither
was trained on, and a third regression on the two calibrated log-odds combines
them. All documents are scored in one pass over whole texts. The threshold keeps
``KEEP`` of the good calibration documents.

Defined results: null texts are empty and score like empty ones; null metadata
is a value of its own; without both classes among the labels every score is the
share of good labels (1 without any) and all documents are kept.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from quakehouse.llm.words import Words, blocks, texts_of

LABELED, POOL, ROUNDS, SHARE, KEEP = 4000, 8000, 4, 0.02, 0.995
WORDS, NAMES = 1024, 64
_CLASS = np.full(256, 6, np.int64)  # 0 lower 1 upper 2 digit 3 space 4 line feed 5 sentence marks 6 other marks 7 beyond ASCII
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[32], _CLASS[10], _CLASS[128:] = 0, 1, 2, 3, 4, 7
_CLASS[[ord(c) for c in ".,;:'\"-?"]] = 5


def _named(kind: str, values: list) -> np.ndarray:
    import zlib

    out = np.zeros((len(values), NAMES))
    for i, v in enumerate(values):
        out[i, zlib.crc32(f"{kind}={v}".encode()) % NAMES] = 1
    return out


def views(texts: list[bytes], source: list, lang: list) -> tuple[np.ndarray, np.ndarray]:
    """Feature matrices (content, metadata) of some documents."""
    w, n = Words(texts), len(texts)
    sizes = np.diff(w.first)
    doc = np.repeat(np.arange(n), sizes)
    bags = np.bincount(doc * WORDS + (w.hash % np.uint64(WORDS)).astype(np.int64), minlength=n * WORDS).reshape(n, WORDS)
    bags = np.sqrt(bags / np.maximum(sizes, 1)[:, None])
    lens = np.array([len(t) for t in texts], dtype=np.int64)
    byte_doc = np.repeat(np.arange(n), lens + 1)[:len(w.raw)]
    kinds = np.bincount(byte_doc * 8 + _CLASS[w.raw], minlength=n * 8).reshape(n, 8).astype(float)
    total = np.maximum(lens, 1)[:, None]
    share = np.minimum(kinds / total, 1)
    word_len = lens / np.maximum(sizes, 1)
    content = np.hstack([bags, 4 * np.sqrt(share), np.minimum(word_len, 20)[:, None] / 10, np.log1p(sizes)[:, None] / 10, np.ones((n, 1))])
    lines = kinds[:, 4] + 1
    layout = np.stack([np.log1p(lens) / 10, np.log1p(lines) / 5, np.log1p(lens / lines) / 5, np.log1p(sizes / lines) / 5,
                       4 * np.sqrt(share[:, 6]), 4 * np.sqrt(share[:, 1]), np.ones(n)], axis=1)
    return content, np.hstack([_named("source", source), _named("lang", lang), layout])


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 150, decay: float = 1e-4) -> np.ndarray:
    """Weights by gradient descent with per-weight step sizes."""
    w, seen = np.zeros(x.shape[1]), np.full(x.shape[1], 1e-8)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ ((p - y) * weight) / weight.sum() + decay * w
        seen += g * g
        w -= 0.5 * g / np.sqrt(seen)
    return w


def balanced(y: np.ndarray) -> np.ndarray:
    good = y.mean()
    return np.where(y == 1, 0.5 / max(good, 1e-9), 0.5 / max(1 - good, 1e-9))


def newton(x: np.ndarray, y: np.ndarray, steps: int = 25, ridge: float = 1e-2) -> np.ndarray:
    """A small logistic regression (calibration, combination)."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(h, x.T @ (p - y) + ridge * w)
    return w


def co_train(x: list[np.ndarray], y: np.ndarray, rounds: int = ROUNDS, share: float = SHARE) -> dict[str, np.ndarray]:
    """Models of both views, their calibration and combination. ``y`` is -1 where unlabelled; every fourth label calibrates."""
    known = np.flatnonzero(y >= 0)
    held, train = known[::4], np.setdiff1d(known, known[::4])
    guess = [np.full(len(y), -1.0), np.full(len(y), -1.0)]  # labels each view was given
    for g in guess:
        g[train] = y[train]
    pool = np.flatnonzero(y < 0)
    good = y[train].mean()
    models = []
    for r in range(rounds + 1):
        models = []
        for v in (0, 1):
            at = np.flatnonzero(guess[v] >= 0)
            models.append(fit_logistic(x[v][at], guess[v][at], balanced(guess[v][at])))
        if r == rounds or not len(pool):
            break
        give = max(1, int(share * len(pool)))
        for v in (0, 1):  # the surest of each class go to the other view
            order = pool[np.argsort(x[v][pool] @ models[v], kind="stable")]
            few, many = max(1, round(give * (1 - good))), max(1, round(give * good))
            guess[1 - v][order[:few]] = 0
            guess[1 - v][order[-many:]] = 1
    odds, cal = [], []
    for v in (0, 1):
        raw = np.stack([x[v][held] @ models[v], np.ones(len(held))], axis=1)
        cal.append(newton(raw, y[held]))
        odds.append(raw @ cal[v])
    both = newton(np.stack([*odds, np.ones(len(held))], axis=1), y[held])
    score = np.stack([*odds, np.ones(len(held))], axis=1) @ both
    limit = float(np.quantile(score[y[held] == 1], 1 - KEEP)) if (y[held] == 1).any() else -math.inf
    return {"content": models[0], "meta": models[1], "cal0": cal[0], "cal1": cal[1], "both": both, "limit": np.array([limit])}


def fit(docs: DataFrame, labels: DataFrame, labeled: int = LABELED, pool: int = POOL, doc_id: str = "doc_id", text: str = "text",
        source: str = "source", lang: str = "lang", label: str = "quality", seed: int = 5) -> dict[str, np.ndarray] | float:
    """Weights, or the share of good labels if only one class is known."""
    key = F.col("__id")
    known = labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("double").alias("__y")).filter("__id IS NOT NULL AND __y IS NOT NULL")
    known = known.groupBy("__id").agg(F.max("__y").alias("__y"))
    some = known.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(labeled)
    rest = (docs.select(F.col(doc_id).alias("__id")).filter(key.isNotNull()).join(known, "__id", "left_anti").distinct()
            .orderBy(F.xxhash64(key, F.lit(seed)), key).limit(pool).select("__id", F.lit(-1.0).alias("__y")))
    picked = F.broadcast(some.unionByName(rest))  # at most labeled + pool rows
    sample = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text"), F.col(source).cast("string").alias("source"),
                         F.col(lang).cast("string").alias("lang")).join(picked, "__id").select("__id", "__y", "text", "source", "lang")
    names = ("content", "meta", "cal0", "cal1", "both", "limit")

    def run(batches):
        parts, ys, ids = [], [], []
        for b in batches:
            for first, end in blocks(b, 2):
                part = b.slice(first, end - first)
                c, m = views(texts_of(b, 2, first, end), part.column(3).to_pylist(), part.column(4).to_pylist())
                parts.append((c.astype(np.float32), m.astype(np.float32)))
                ys += part.column(1).to_pylist()
                ids += part.column(0).to_pylist()
        if not ids:
            return
        order = np.argsort(np.array(ids), kind="stable")
        y = np.array(ys)[order]
        share = float((y[y >= 0] == 1).mean()) if (y >= 0).any() else 1.0
        if (y[y >= 0][1:] == 0).sum() < 4 or (y == 1).sum() < 4:
            yield pa.RecordBatch.from_arrays([pa.array([share])] + [pa.array([b""], pa.binary())] * len(names), ["share", *names])
            return
        x = [np.concatenate([p[v] for p in parts])[order] for v in (0, 1)]
        m = co_train(x, y)
        yield pa.RecordBatch.from_arrays([pa.array([share])] + [pa.array([m[k].astype(float).tobytes()], pa.binary()) for k in names], ["share", *names])

    got = sample.repartition(1).mapInArrow(run, "share double, " + ", ".join(f"{n} binary" for n in names)).collect()
    if not got or not got[0]["both"]:
        return got[0]["share"] if got else 1.0
    return {k: np.frombuffer(got[0][k]) for k in names}


def score(docs: DataFrame, model, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """doc_id, content_score, meta_score, quality_score, kept for every document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(source).cast("string").alias("source"),
                       F.col(lang).cast("string").alias("lang"))
    if isinstance(model, float):
        return rows.select("doc_id", *[F.lit(model).alias(n) for n in ("content_score", "meta_score", "quality_score")], F.lit(True).alias("kept"))
    out = T.StructType([rows.schema["doc_id"]] + [T.StructField(n, T.DoubleType()) for n in ("content_score", "meta_score", "quality_score")]
                       + [T.StructField("kept", T.BooleanType())])

    def run(batches):
        for b in batches:
            for first, end in blocks(b, 1):
                part = b.slice(first, end - first)
                c, m = views(texts_of(b, 1, first, end), part.column(2).to_pylist(), part.column(3).to_pylist())
                odds = [(x @ model[v]) * model[f"cal{i}"][0] + model[f"cal{i}"][1] for i, (x, v) in enumerate(((c, "content"), (m, "meta")))]
                both = odds[0] * model["both"][0] + odds[1] * model["both"][1] + model["both"][2]
                p = [1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (*odds, both)]
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(z) for z in p], pa.array(both >= model["limit"][0])], out.names)

    return rows.mapInArrow(run, out)
