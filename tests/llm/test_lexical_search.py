import math
import random
import re

import duckdb
import numpy as np

from quakehouse.llm import lexical_search as L
from quakehouse.llm.queries import ORACLE, QUERIES, table

SF = "/root/testdata/sf0.01"


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k=10):
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    n_docs, n_terms, df = len(held), sum(len(w) for _, w in held), {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        asked = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in set(terms(text)) if t in df}
        scored = []
        for i, w in held:
            m = 10 + (90 * len(w) * n_docs) // n_terms
            s = sum(v * ((1000000000 * w.count(t)) // (1000 * w.count(t) + 8 * m)) for t, v in asked.items() if t in w)
            if s > 0 and i is not None:
                scored.append((-s, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def test_contract_table_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.register(t, spark.read.parquet(f"{SF}/{t}.parquet").toPandas())
    got = QUERIES["op11_sketch_search"](spark, SF)
    assert got.columns[:4] == ["item_id", "rank", "doc_id", "score"]
    want = con.execute(ORACLE["op11_sketch_search"]).fetchall()
    assert len(want) > 300 and sorted(map(tuple, got.collect())) == sorted(want)


def test_odd_rows_match_brute_force(spark):
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(60)] + ["É", "é", "Ünder", "x1y"]
    docs = [(i, rnd.choice([" ", "-", "\n", "_"]).join(rnd.choice(vocab[:rnd.randrange(3, 64)]) for _ in range(rnd.randrange(1, 80)))) for i in range(300)]
    docs += [(400 + i, docs[7][1]) for i in range(30)]  # ties
    docs += [(500, None), (501, ""), (502, " -!\t"), (None, "w1 w2 É"), (7, docs[7][1]), (7, "w3 W3 w3"), (503, "w5 " * 200_000 + "rare")]
    items = [(1, "w1 W2 w2 É"), (2, None), (3, ""), (4, "nothing here"), (5, "rare w5"), (5, "w3"), (None, "x1y é"), (6, "...")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5).selectExpr("*", "'a' AS item_id", "1 AS score", "2 AS q", "3 AS part", "4 AS what")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'a' AS doc_id", "1 AS rank")
    for batch in (250_000, 1):  # one batch, one a row
        got = sorted(map(tuple, L.search(d, b, batch=batch).collect()), key=str)
        assert got == brute(docs, items)
    assert L.search(d.limit(0), b).count() == 0 and L.search(d, b.limit(0)).count() == 0
    assert L.search(d, b.filter("text IS NULL")).count() == 0


def test_bounds_hold_and_spare_work(spark):
    docs = table(spark, SF, "documents").select("text").collect()
    texts = [(r.text or "").encode() for r in docs]
    queries = L.Queries([(r.text or "").encode() for r in table(spark, SF, "benchmark").collect()])
    post = L.Postings(texts)
    count, total = int((post.n > 0).sum()), int(post.n.sum())
    df = np.array([int((post.code == c).sum()) if c >= 0 else 0 for c in post.codes(queries.terms)])
    queries.weigh(count, df)
    impact = L.impacts(post.tf, post.n[post.doc], count, total)
    every = np.flatnonzero(post.n)
    bound = L.Sketches(post, impact).bounds(every, queries)
    here = post.codes(queries.terms)
    for q in queries.asking.tolist():
        t = queries.of(q)
        assert (bound[:, q] >= post.impacts_of(every, here[t], impact) @ queries.weight[t]).all()
    scored = L.search_block(np.arange(len(texts)), texts, queries, [L.Best(10) for _ in range(queries.number)], count, total)
    assert scored < len(every) * queries.number // 4
