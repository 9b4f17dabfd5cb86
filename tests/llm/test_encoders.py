"""Ops 3, 5, 6, 8, 9 and 10 against the libraries and brute force."""

import hashlib
import textwrap
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quakehouse.llm import bpe, exact_dedup, licenses, packing, token_counts, topk
from quakehouse.llm.queries import ORACLE, QUERIES, table

SF = "/root/testdata/sf0.001"
WORD = P.path("word_bpe_49k.json")
ODD = [None, "", " \t\n", "Hello <|endoftext|> World's don't 12ab", "Σας İx é́ 中文字 😀👍 ﬁ ǅ", "a\x1fb \x1c c\u0085d　e",
       "&&&'s***''ll x<|endoftext|>'s y", "word " * 40_000]


def odd(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (3, ODD[3])]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' ids", "1 length", "2 AS digest", "'z' AS file")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(WORD)
    t.no_truncation(), t.no_padding()
    return t


def test_bpe_equals_the_library(spark, tokenizer):
    got = {r.doc_id: r for r in QUERIES["op6_forced_boundary_bpe"](spark, SF).collect()}
    for r in table(spark, SF, "documents").collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        g = got[r.doc_id]
        assert g.n_tokens == len(ids) and g.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert g.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    out = bpe.encode(odd(spark), WORD, decoded="decoded")
    for r in out.collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == tokenizer.encode(r.text or "", add_special_tokens=False).ids
    assert out.count() == len(ODD) + 2 and bpe.encode(odd(spark).limit(0), WORD).count() == 0
    assert [r.decoded for r in bpe.decode(out.drop("decoded"), WORD).collect()] == [r.decoded for r in out.collect()]


def test_no_cut_goes_through_a_token():
    m = bpe.model(WORD)
    assert all(m.fragments(t.removesuffix("</w>")) == [t.removesuffix("</w>")] for t in list(m.vocab)[::50] if t != "</w>")


def check_packing(rows, texts, tokenizer, size=2048):
    want = sorted((i if i is not None else -1, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])) for i, t in texts)
    crcs = sorted((i, s, min(size, len(x) - s), zlib.crc32(np.array(x[s:s + size], "<u4").tobytes()), len(x)) for i, x in want for s in range(0, len(x), size))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == crcs
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= size
    return len(by)


def test_packing(spark, tokenizer):
    docs = table(spark, SF, "documents")
    rows = QUERIES["op5_cutting_stock_packing"](spark, SF).collect()
    n = check_packing(rows, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], tokenizer)
    assert sum(r.length for r in rows) / (n * 2048) > 0.95
    few = odd(spark)
    check_packing(packing.pack(few, WORD).collect(), [(r.doc_id, r.text) for r in few.collect()], tokenizer)
    assert packing.pack(few.limit(0), WORD).count() == 0


def test_plan_covers_the_histogram():
    h = {3: 100, 5: 40, 8: 7, 16: 9, 11: 30}
    made = packing.plan(h, 16)
    assert {c: sum(p.get(c, 0) * k for p, k in made) for c in h} == h
    assert all(sum(c * m for c, m in p.items()) <= 16 for p, _ in made)
    assert packing.plan({}, 16) == []


def test_streaming_dedup_with_colliding_digests_and_later_files(spark, tmp_path):
    df = odd(spark)
    path = str(tmp_path / "docs")
    df.repartition(4).write.parquet(path)
    weak = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.dedup(
        spark, path, digest=lambda c: F.substring(F.sha2(c, 256), 1, 1), files_per_batch=1).collect()}
    strong = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.dedup(spark, path).collect()}
    assert weak == strong and strong[0][:2] == (1, 2) and strong[None][1] == 1
    state = str(tmp_path / "state")
    exact_dedup.stream_state(spark, path, checkpoint=state)
    spark.createDataFrame([(99, "null id")], "doc_id long, text string").selectExpr("*", "'x' ids", "1 length", "2 AS digest", "'z' AS file").write.mode("append").parquet(path)
    later = [r for r in exact_dedup.stream_state(spark, path, checkpoint=state).collect() if r.keep.id == 99]
    assert len(later) == 1 and later[0].group_size == 2  # the state of the first run is still there
    kept = exact_dedup.keep_first(df)
    assert kept.columns == df.columns and kept.count() == len(set(t or "" for t in ODD)) + 1
    assert exact_dedup.keep_first(df.limit(0)).count() == 0


def test_topk_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8)], 1) for i in range(700)]
    rows += [(1000 + i, rows[5][1], 1) for i in range(400)]  # one vector many times
    rows += [(800, None, 1), (900, [1.0, None] + [0.0] * 6, 1), (1500, [float("nan")] * 8, 1), (1600, [float("inf")] * 8, 1), (None, rows[0][1], 1), (7, rows[7][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 100 == 0, shard=300, block=4).collect()}
    good = {i: np.floor(1024 * np.array(v)).astype(np.int64) for i, v, _ in rows if i is not None and i not in (800, 900, 1500, 1600)}
    want = {}
    for q in good:
        if q % 100 == 0:
            best = sorted(((-int(v @ good[q]), i) for i, v in good.items() if i != q))[:10]
            want |= {(q, r + 1): (i, -s) for r, (s, i) in enumerate(best)}
    assert got == want
    assert topk.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    few = topk.top_k(df.filter("vec_id IN (0, 1, 2)"), F.col("vec_id") % 100 == 0).collect()
    assert len(few) == 2


def test_topk_keeps_rows_that_share_an_identifier(spark):
    rows = [(0, [1.0, 0.0]), (1, [-5.0, 0.0]), (1, [3.0, 0.0]), (2, [2.0, 0.0]), (100, [1.0, 0.0]), (100, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 100 == 0, k=3).collect())
    pairs = {q: sorted((-int(1024 * 1024 * (a @ b)), j) for i, a in [(i, np.array(v)) for i, v in rows] if i == q
                       for j, b in [(j, np.array(v)) for j, v in rows] if j != q)[:3] for q in (0, 100)}
    assert got == [(q, n + 1, j, -s) for q in (0, 100) for n, (s, j) in enumerate(pairs[q])]
    assert got[0] == (0, 1, 1, 3 << 20)


def test_token_attribution(spark):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    df = odd(spark).limit(7).selectExpr("*", "'src' source", "CAST(NULL AS string) lang", "'n' name", "3 section")
    for rule in ("first", "most"):
        out = {}
        for r in token_counts.count_tokens(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, rule=rule).collect():
            out.setdefault(r.doc_id, []).append(r)
        for doc_id, body in [(r.doc_id, r.text) for r in df.collect()]:
            whole = "\n".join(["src", "", body or ""])
            parts, n = sorted(out[doc_id], key=lambda r: r.section), len(library.encode(whole, add_special_tokens=False).ids)
            assert sum(p.n_tokens for p in parts) == n == parts[0].doc_tokens
            assert "\n".join(whole[p.start:p.end] for p in parts) == whole
    held, crossing = token_counts.attribute(np.array([0, 2, 5]), np.array([2, 5, 9]), np.array([0, 3, 6]), "most")
    assert held.tolist() == [1, 1, 1] and crossing.tolist() == [0, 1, 1]
    assert token_counts.attribute(np.array([0, 2, 5]), np.array([2, 5, 9]), np.array([0, 3, 6]), "first")[0].tolist() == [2, 1, 0]


def test_licences(spark):
    text = "Copyright (c) 2020 Someone\n\n" + licenses.KNOWN[0][1].replace(". ", ".\n").upper()
    rows = [(1, text), (2, "released under the  MIT licence"), (3, "x\nLicensed under CC BY-NC 4.0.\ny"), (4, None), (5, ""), (6, "not a license"), (None, "Released under the MIT License.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 line", "'d' digest", "'b' body")
    got = sorted((str(r.doc_id), r.unit, r.line, r.license) for r in licenses.scan(df).collect())
    assert got == [("1", "text", None, "MIT"), ("2", "text", None, "MIT"), ("3", "line", 1, "CC-BY-NC-4.0"), ("None", "text", None, "MIT")]
    assert licenses.scan(df.limit(0)).count() == 0


def test_licences_wrapped_anywhere(spark):
    notice = "Copyright (c) 2020 Someone\n(c) 2021 by Others\nCopyright 2022 A, B\nCopyright by C\nAll rights reserved.\n\n"
    rows = [(f"{n} {width}", notice + textwrap.fill(said, width)) for n, (_, said) in enumerate(licenses.KNOWN) for width in (30, 47, 60, 72, 79, 100)]
    rows += [(f"{n} word", notice + "\n".join(said.split())) for n, (_, said) in enumerate(licenses.KNOWN)]
    got = {r.doc_id: r.license for r in licenses.scan(spark.createDataFrame(rows, "doc_id string, text string")).filter("unit = 'text'").collect()}
    print("wrapped texts matched", len(got), "of", len(rows))
    assert got == {i: licenses.KNOWN[int(i.split()[0])][0] for i, _ in rows}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracles(spark, name):
    from tests.oracle_check import compare, duck

    message, good = compare(spark, duck(SF), name, QUERIES[name], ORACLE[name], SF)
    assert good, message
