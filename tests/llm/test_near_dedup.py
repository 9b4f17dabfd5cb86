import re

from quakehouse.llm import linking, near_dedup
from quakehouse.llm.queries import QUERIES, table

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text, n=2):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = WORD.findall(low)
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def brute(rows, n=2):
    sets = {i: shingles(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    held = {}
    for i, s in sets.items():
        for g in s:
            held.setdefault(g, []).append(i)
    ids = sorted(sets)
    for x in ids:
        near = {}
        for g in sets[x]:
            for y in held[g]:
                if y < x:
                    near[y] = near.get(y, 0) + 1
        for y, both in near.items():
            if 100 * both >= 80 * (len(sets[x]) + len(sets[y]) - both):
                a, b = sorted((top(x), top(y)))
                root[b] = a
    return {i: (len(sets[i]), top(i)) for i in ids}


def check(rows, got):
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_whole_table_matches_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()
    check([(r.doc_id, r.text) for r in docs], QUERIES["op7_bottom_k_near_dedup"](spark, "/root/testdata/sf0.01").collect())


def test_edges(spark):
    base = [f"w{i}" for i in range(120)]
    rows = [(1, None), (2, ""), (3, " \t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One\x0btwo"), (8, "é É"), (9, "é é")]
    rows += [(100 + i, " ".join(base[:3 * i] + ["x"] + base[3 * i + 1:])) for i in range(30)]  # a near group
    rows += [(200 + i, " ".join(f"v{j}" for j in range(6 * i, 6 * i + 60))) for i in range(20)]  # a chain
    rows += [(300 + i, "the common line that all share " * 3 + " ".join(f"u{i}x{j}" for j in range(9))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS node", "'x' AS class", "2 AS key")
    check(rows, near_dedup.near_duplicates(df).collect())
    kept = near_dedup.keep_one(df, n=2)
    assert kept.columns == df.columns and kept.count() == len({c for _, c in brute(rows).values()})


def test_null_ids_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (2, "a b c"), (2, "a b c"), (1, "a b c")], "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in near_dedup.near_duplicates(df).collect())
    assert got == [("1", "1", True), ("2", "1", False), ("2", "1", False), ("None", "None", True), ("None", "None", True)]
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)]
    got = dict(linking.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(51)) and all(got[100 + i] == 100 for i in range(40)) and len(got) == 91
