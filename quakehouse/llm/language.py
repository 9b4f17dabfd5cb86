"""Op 2: language identification by a linear-chain conditional random field.

Every word of a text gets a language. A word's features are its hash (lexicon),
its first and last two and three bytes (affixes) and its byte trigrams; learned
transitions tie neighbouring words, so switches inside a text are followed.
Forward-backward gives each word's posterior, and a document's language is the
one with the highest mean posterior over its words with letters.

Training uses a documented, bounded sample: at most ``PER_LANG`` labelled rows of
each language (smallest hash of the identifier first), cut into sequences that
switch language between pieces of different documents, ``TRAIN_WORDS`` words in
all. Prediction reads whole texts, and only the text.

Defined results: text that is null or has no letter is ``und`` with score 0, as
is every text if nothing is labelled; rows that repeat are predicted each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from quakehouse.llm.words import Words, _LOWER, blocks, mix, texts_of

PER_LANG, TRAIN_WORDS, LENGTH, BATCH, RATE = 300, 400_000, 48, 64, 0.3
LEXICON, GRAMS = 1 << 17, 1 << 16


def features(w: Words, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids of the given words, word after word, and where each word's begin."""
    start, size = w.start[words], (w.end - w.start)[words]
    raw = _LOWER[w.raw].astype(np.uint64)

    def byte(at, ok):
        return np.where(ok, raw[np.minimum(at, len(raw) - 1)], 0).astype(np.uint64)

    def bucket(kind: int, *parts) -> np.ndarray:
        x = np.full(len(parts[0]), kind, np.uint64)
        for p in parts:
            x = x * np.uint64(257) + p
        return (mix(x) & np.uint64(GRAMS - 1)).astype(np.int64) + LEXICON

    end = start + size
    fixed = [(w.hash[words] & np.uint64(LEXICON - 1)).astype(np.int64)]
    for n in (2, 3):
        ok = [size > k for k in range(n)]
        fixed.append(bucket(10 + n, *[byte(start + k, ok[k]) for k in range(n)]))
        fixed.append(bucket(20 + n, *[byte(end - 1 - k, ok[k]) for k in range(n)]))
    grams = np.maximum(size - 2, 0)
    counts = len(fixed) + grams
    first = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.int64)
    for k, f in enumerate(fixed):
        out[first + k] = f
    place = np.arange(int(grams.sum())) - np.repeat(np.cumsum(grams) - grams, grams)
    at = np.repeat(start, grams) + place
    out[np.repeat(first + len(fixed), grams) + place] = bucket(33, raw[at], raw[at + 1], raw[at + 2])
    return out, first


def emissions(w: Words, weights: np.ndarray) -> np.ndarray:
    """Log scores (words, languages); each distinct word is scored once."""
    _, at, back = np.unique(w.hash, return_index=True, return_inverse=True)
    ids, first = features(w, at)
    return np.add.reduceat(weights[ids], first, axis=0)[back]


def posteriors(scores: np.ndarray, sizes: np.ndarray, move: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Forward-backward over all texts at once: step t handles the t-th word of every text that has one."""
    rank = np.empty(len(sizes), np.int64)
    rank[np.argsort(-sizes, kind="stable")] = np.arange(len(sizes))
    first = np.cumsum(sizes) - sizes
    t = np.arange(len(scores)) - np.repeat(first, sizes)
    order = np.lexsort((np.repeat(rank, sizes), t))
    e = np.exp(scores - scores.max(axis=1, keepdims=True))[order]
    live = np.bincount(t)
    at = np.concatenate(([0], np.cumsum(live)))
    step = np.exp(move)
    forward = np.empty_like(e)
    a = np.exp(begin)[None, :] * e[:live[0]]
    forward[:live[0]] = a = a / a.sum(axis=1, keepdims=True)
    for i in range(1, len(live)):
        a = (a[:live[i]] @ step) * e[at[i]:at[i + 1]]
        a /= a.sum(axis=1, keepdims=True)
        forward[at[i]:at[i + 1]] = a
    b = np.ones((live[-1], e.shape[1]))
    for i in range(len(live) - 2, -1, -1):
        nb = np.ones((live[i], e.shape[1]))
        k = live[i + 1]
        nb[:k] = (b * e[at[i + 1]:at[i + 2]]) @ step.T
        nb[:k] /= nb[:k].sum(axis=1, keepdims=True)
        forward[at[i]:at[i + 1]] *= nb
        b = nb
    out = np.empty_like(forward)
    out[order] = forward / forward.sum(axis=1, keepdims=True)
    return out


def train(texts: list[bytes], labels: np.ndarray, n_langs: int, words: int = TRAIN_WORDS, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights by stochastic ascent of the conditional log-likelihood, with per-weight step sizes."""
    rng = np.random.default_rng(seed)
    w = Words(texts)
    sizes = np.diff(w.first)
    pools = [np.flatnonzero((labels == g) & (sizes > 0)) for g in range(n_langs)]
    pools = [p for p in pools if len(p)]
    weights = np.zeros((LEXICON + GRAMS, n_langs))
    move, begin = np.zeros((n_langs, n_langs)), np.zeros(n_langs)
    sums = [np.full_like(x, 1e-2) for x in (weights, move, begin)]

    def ascend(k, array, where, grad):
        sums[k][where] += grad ** 2
        array[where] += RATE * grad / np.sqrt(sums[k][where])

    for _ in range(max(1, words // (LENGTH * BATCH))):
        rows, tags, lens = [], [], []
        for _ in range(BATCH):
            got = 0
            while got < LENGTH:  # pieces of different texts, one after the other
                pool = pools[rng.integers(len(pools))]
                d = int(pool[rng.integers(len(pool))])
                n = int(min(sizes[d], LENGTH - got, rng.integers(4, LENGTH)))
                s = int(w.first[d] + rng.integers(sizes[d] - n + 1))
                rows.append(np.arange(s, s + n))
                tags.append(np.full(n, labels[d]))
                got += n
            lens.append(LENGTH)
        at, y = np.concatenate(rows), np.concatenate(tags)
        ids, first = features(w, at)
        scores = np.add.reduceat(weights[ids], first, axis=0)
        p = posteriors(scores, np.array(lens), move, begin)
        grad = -p
        grad[np.arange(len(y)), y] += 1
        each = np.repeat(grad, np.diff(np.append(first, len(ids))), axis=0)
        unique, back = np.unique(ids, return_inverse=True)
        total = np.stack([np.bincount(back, each[:, g], len(unique)) for g in range(n_langs)], axis=1)
        ascend(0, weights, unique, total / BATCH)
        # transitions: observed pairs less the expected ones
        shape = (BATCH, LENGTH)
        e, q = np.exp(scores - scores.max(1, keepdims=True)).reshape(*shape, -1), p.reshape(*shape, -1)
        joint = q[:, :-1, :, None] * np.exp(move) * e[:, 1:, None, :] * (q[:, 1:] / np.maximum(e[:, 1:], 1e-12))[:, :, None, :]
        joint /= np.maximum(joint.sum(axis=(2, 3), keepdims=True), 1e-300)
        yy = y.reshape(shape)
        seen = np.zeros_like(move)
        np.add.at(seen, (yy[:, :-1].ravel(), yy[:, 1:].ravel()), 1)
        ascend(1, move, ..., (seen - joint.sum(axis=(0, 1))) / BATCH)
        ascend(2, begin, ..., (np.bincount(yy[:, 0], minlength=n_langs) - q[:, 0].sum(0)) / BATCH)
    return {"weights": weights.astype(np.float32), "move": move, "begin": begin}


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, per_lang: int = PER_LANG, words: int = TRAIN_WORDS, doc_id: str = "doc_id", text: str = "text",
        lang: str = "lang") -> tuple[list[str], dict[str, np.ndarray]] | None:
    """Languages and weights learned from the labelled rows of ``docs``; None if there are none."""
    key = F.col(doc_id)
    labelled = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & key.isNotNull())
    order = Window.partitionBy(lang).orderBy(F.xxhash64(key), key)
    picked = (labelled.select(key, F.col(lang).alias(lang)).withColumn("n", F.row_number().over(order))
              .filter(F.col("n") <= per_lang).select(key.alias("__id")).distinct())
    sample = labelled.join(F.broadcast(picked), key == F.col("__id"), "left_semi").select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))

    def run(batches):
        table = pa.Table.from_batches(list(batches)).sort_by([("lang", "ascending"), ("text", "ascending")])
        names = sorted(set(table["lang"].to_pylist()))
        if names:
            model = train([t.encode() for t in table["text"].to_pylist()], np.array([names.index(x) for x in table["lang"].to_pylist()]), len(names), words)
            yield pa.RecordBatch.from_arrays([pa.array([names], pa.list_(pa.string()))] + [
                pa.array([model[k].tobytes()], pa.binary()) for k in ("weights", "move", "begin")], ["names", "weights", "move", "begin"])

    got = sample.repartition(1).mapInArrow(run, "names array<string>, weights binary, move binary, begin binary").collect()
    if not got:
        return None
    names = list(got[0]["names"])
    n = len(names)
    return names, {"weights": np.frombuffer(got[0]["weights"], np.float32).reshape(-1, n),
                   "move": np.frombuffer(got[0]["move"]).reshape(n, n), "begin": np.frombuffer(got[0]["begin"])}


def predict(docs: DataFrame, model, text: str = "text", sure: str | None = None) -> DataFrame:
    """``docs`` with lang_pred and score; column ``sure``, if named, is the mean over the words with letters of each one's highest posterior."""
    extra = [sure] if sure else []
    keep = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score", sure)]
    names = [f.name for f in keep]
    at = names.index(text)
    schema = T.StructType(keep + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), *(T.StructField(x, T.DoubleType()) for x in extra), T.StructField("__letter", T.BooleanType())])
    rows = docs.select(*names, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("__letter"))
    if model is None:
        return rows.select(*names, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), *(F.lit(0.0).alias(x) for x in extra))
    langs, m = model
    letters = np.zeros(256, bool)
    letters[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True

    def run(batches):
        for b in batches:
            for first, end in blocks(b, at):
                w = Words(texts_of(b, at, first, end))
                sizes, n = np.diff(w.first), end - first
                total, words, best = np.zeros((n, len(langs))), np.zeros(n), np.zeros(n)
                if len(w.hash):
                    text_of = np.repeat(np.arange(n), sizes)
                    p = posteriors(emissions(w, m["weights"]), sizes, m["move"], m["begin"])
                    marks = np.concatenate(([0], np.cumsum(letters[w.raw])))
                    has = (marks[w.end] > marks[w.start]).astype(float)
                    words = np.bincount(text_of, has, n)
                    best = np.bincount(text_of, p.max(1) * has, n)
                    for g in range(len(langs)):
                        total[:, g] = np.bincount(text_of, p[:, g] * has, n)
                mean = total / np.maximum(words, 1)[:, None]
                part = b.slice(first, end - first)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(names))] + [pa.array([langs[i] for i in mean.argmax(1)]),
                     pa.array(np.clip(mean.max(1), 0, 1)), *(pa.array(np.clip(best / np.maximum(words, 1), 0, 1)) for _ in extra),
                     part.column(len(names))], [*names, "lang_pred", "score", *extra, "__letter"])

    out = rows.mapInArrow(run, schema)
    return out.select(*names, F.when(F.col("__letter"), F.col("lang_pred")).otherwise("und").alias("lang_pred"),
                      *(F.when(F.col("__letter"), F.col(x)).otherwise(0.0).alias(x) for x in ("score", *extra)))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows that are not held out."""
    model = fit(docs.filter(~held_out(F.col(doc_id))), doc_id=doc_id, text=text, lang=lang)
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return predict(read, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
