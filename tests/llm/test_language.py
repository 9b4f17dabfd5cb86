import zlib

import numpy as np

from quakehouse.llm import language as L
from quakehouse.llm.queries import QUERIES, table
from quakehouse.llm.words import Words


def test_posteriors_match_all_paths():
    rng = np.random.default_rng(1)
    sizes, move, begin = np.array([3, 1, 5]), rng.normal(size=(2, 2)), rng.normal(size=2)
    scores = rng.normal(size=(9, 2))
    got = L.posteriors(scores, sizes, move, begin)
    at = 0
    for n in sizes:
        want = np.zeros((n, 2))
        for path in np.ndindex(*[2] * n):
            s = begin[path[0]] + sum(scores[at + i, p] for i, p in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:]))
            for i, p in enumerate(path):
                want[i, p] += np.exp(s)
        assert np.allclose(got[at:at + n], want / want.sum(1, keepdims=True))
        at += n


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.lang for r in table(spark, sf, "documents").select("doc_id", "lang").collect()}
    got = QUERIES["op2_crf_language"](spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and docs[r.doc_id]]
    right = sum(r.lang_pred == docs[r.doc_id] for r in held) / len(held)
    print("held-out accuracy", right, len(held))
    assert right > 0.97


def test_code_switched_words_and_edges(spark):
    a, b = "der und nicht ist sich auch", "the and with that this from"
    rows = [(i, " ".join([a] * 8) if i % 2 else " ".join([b] * 8), "de" if i % 2 else "en") for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, m = L.fit(df, words=40_000)
    w = Words([f"{a} {b} {a}".encode()])
    p = L.posteriors(L.emissions(w, m["weights"]), np.array([18]), m["move"], m["begin"]).argmax(1)
    assert [names[i] for i in p] == ["de"] * 6 + ["en"] * 6 + ["de"] * 6
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 — !"), (None, a), (4, a + " x" * 30_000), (4, b)], "doc_id long, text string").selectExpr("*", "'x' score", "1 lang_pred")
    got = [(r.doc_id, r.lang_pred) for r in L.predict(odd, (names, m)).collect()]
    assert got[:4] == [(1, "und"), (2, "und"), (3, "und"), (None, "de")] and got[5] == (4, "en")
    assert L.fit(df.limit(0)) is None and {r.lang_pred for r in L.predict(odd, None).collect()} == {"und"}
    assert L.identify(df.limit(0)).count() == 0
