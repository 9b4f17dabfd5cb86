import hashlib
import random
import re
import zlib

import numpy as np

from quakehouse.llm import periodic_runs as P
from quakehouse.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.001"


def brute(words, least=12):
    """Every period in turn: maximal stretches that equal themselves that far on, without those of a smaller period."""
    at = {w: i for i, w in enumerate(dict.fromkeys(words))}
    codes = np.array([at[w] for w in words], np.int64)
    found = set()
    for q in range(1, len(codes) // 2 + 1):
        same = np.concatenate(([0], codes[q:] == codes[:-q], [0])).astype(np.int8)
        turn = np.flatnonzero(np.diff(same))
        for s, e in zip(turn[0::2].tolist(), turn[1::2].tolist()):
            length = e - s + q
            if length >= max(least, 2 * q) and not any((s, length, d) in found for d in range(1, q) if q % d == 0):
                found.add((s, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def test_runs_of_random_lists():
    rnd = random.Random(1)
    for _ in range(1500):
        n, kinds, w = rnd.randrange(60), rnd.choice([1, 2, 3, 5, 20]), []
        while len(w) < n:
            w += [b"w%d" % rnd.randrange(kinds) for _ in range(rnd.randrange(1, 9))] * rnd.choice([1, 1, 2, 3, 5])
        least = rnd.choice([2, 4, 12])
        runs, text = P.periodic(b" ".join(w), least)
        assert list(map(tuple, runs.tolist())) == brute(w, least)
        assert text == collapsed(w, brute(w, least))


def test_suffix_tree_orders_suffixes_and_extends():
    rnd = random.Random(2)
    for _ in range(200):
        s = [rnd.randrange(1, 4) for _ in range(rnd.randrange(1, 40))]
        order = P.SuffixTree(s).tour()[0].tolist()
        assert order == sorted(range(len(s) + 1), key=lambda i: s[i:])
        ext = P.Extensions(s)
        pairs = [(i, j) for i in range(len(s)) for j in range(len(s) + 1) if i != j]
        want = [next((k for k in range(len(s)) if max(i, j) + k >= len(s) or s[i + k] != s[j + k]), len(s)) for i, j in pairs]
        assert ext.common(*np.array(pairs).T).tolist() == want


def test_contract_table_matches_brute_force(spark):
    rows = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    some = 0
    for d in docs:
        w = split(d.text)
        h, n = zlib.crc32(str(d.doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        r = rows[d.doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(w, runs)).hexdigest()
        some += bool(runs)
    assert some > 5


def test_odd_rows(spark):
    long = [f"x{i % 70000}" for i in range(200_000)]
    texts = [None, "", " \t\n", "one", "a " * 11, "a " * 12, "\x0bA\x0ca a " * 12, "a " * 12, "é ü\r" * 8, "w " * 50_000, " ".join(long)]
    df = spark.createDataFrame([(None if i == 4 else min(i, 6), t) for i, t in enumerate(texts)], "doc_id int, text string")
    df = df.selectExpr("*", "'z' AS runs", "1 AS collapsed", "2 AS start", "'q' AS words")
    got = P.find_runs(df).collect()
    key = lambda r: (r[0] is None, r[0] or 0, len(r[1] or ""))
    assert sorted([r.doc_id for r in got if r.doc_id is not None]) == [0, 1, 2, 3, 5, 6, 6, 6, 6, 6]
    want = []
    for i, t in zip([r.doc_id for r in df.collect()], texts):
        w = split(t)
        runs = [(0, 50_000, 1)] if t and t.startswith("w ") else [(0, 200_000, 70_000)] if len(w) == 200_000 else brute(w)
        want.append((i, [tuple(x) for x in runs], collapsed(w, runs).decode()))
    have = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in got]
    assert sorted(have, key=lambda r: key((r[0], r[2]))) == sorted(want, key=lambda r: key((r[0], r[2])))
    assert P.find_runs(df.limit(0)).count() == 0
