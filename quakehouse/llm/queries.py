"""The dealt operators' queries: thin wrappers that read whole tables and shape contract columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

WORD_BPE = "word_bpe_49k.json"


def query(name: str):
    def put(f):
        QUERIES[name] = f
        return f
    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op6_forced_boundary_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quakehouse.llm import bpe

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = bpe.encode(docs, public_tokenizers.path(WORD_BPE), ids="ids", decoded="decoded")
    return rows.select("doc_id", bpe.n_ids(F.col("ids")).alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op5_cutting_stock_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quakehouse.llm import packing

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


@query("op10_streaming_exact_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quakehouse.llm import exact_dedup

    return exact_dedup.dedup(spark, f"{sf_dir}/documents.parquet").withColumnRenamed("digest", "text_sha256")


ORACLE["op10_streaming_exact_dedup"] = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.body) AS text_sha256
FROM t JOIN g ON t.body = g.body
"""


@query("op7_bottom_k_near_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quakehouse.llm import near_dedup

    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_paragraph_minhash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quakehouse.llm import substring_dedup

    return substring_dedup.repeats(table(spark, sf_dir, "documents"))


@query("op9_maxscore_topk")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quakehouse.llm import topk

    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE["op9_maxscore_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query("op3_token_attribution")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quakehouse.llm import token_counts

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                     public_tokenizers.PATTERN)


@query("op8_license_digests")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quakehouse.llm import licenses

    return licenses.scan(table(spark, sf_dir, "documents"))


def _op8_oracle() -> str:
    """The same scan in SQL: the known texts are normalised there too, with RE2's spelling of the patterns."""
    from quakehouse.llm.licenses import COPYRIGHT, KNOWN, SPELLINGS

    def canonical(x: str) -> str:
        out = f"regexp_replace(lower({x}), '{COPYRIGHT}', ' ', 'g')"
        out = f"trim(regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
        for said, means in SPELLINGS:
            out = f"regexp_replace({out}, '\\b{said}\\b', '{means}', 'g')"
        return out
    values = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in KNOWN)
    return f"""
WITH known AS (SELECT DISTINCT license, {canonical('said')} AS body FROM (VALUES {values}) AS k(license, said)),
whole AS (SELECT doc_id, 'text' AS unit, NULL::INTEGER AS line, text AS said FROM documents),
cut AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE contains(text, chr(10))),
lines AS (SELECT doc_id, 'line' AS unit, (i - 1)::INTEGER AS line, parts[i] AS said
          FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM cut)),
units AS (SELECT doc_id, unit, line, {canonical('said')} AS body FROM (SELECT * FROM whole UNION ALL SELECT * FROM lines))
SELECT u.doc_id, u.unit, u.line, k.license, sha256(u.body) AS digest FROM units u JOIN known k ON u.body = k.body
"""


ORACLE["op8_license_digests"] = _op8_oracle()


@query("op2_crf_language")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quakehouse.llm import language

    return language.identify(table(spark, sf_dir, "documents"))


@query("op1_cotraining_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quakehouse.llm import quality

    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


#: the rules of op12: host, path, verdict
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


@query("op12_link_trust")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quakehouse.llm import link_trust

    return link_trust.judge(table(spark, sf_dir, "pages"), URL_RULES)


def _op12_oracle() -> str:
    """The same verdicts in SQL: one common table a round, all integer arithmetic."""
    from quakehouse.llm.link_trust import DAMPING, HREF, LOWER, ROUNDS, UNIT, UPPER, URL

    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    href = HREF.replace("'", "''")
    steps = "".join(f""",
m{k} AS MATERIALIZED (SELECT e.kind, e.dst AS host, sum((m.mass * {DAMPING} // 100) // e.fan)::BIGINT AS mass
  FROM m{k - 1} m JOIN e ON e.kind = m.kind AND e.src = m.host GROUP BY ALL HAVING sum((m.mass * {DAMPING} // 100) // e.fan) > 0)""" for k in range(1, ROUNDS + 1))
    return f"""
WITH rules(h, p, verdict) AS (VALUES {rules}),
u AS MATERIALIZED (SELECT page_id, html, coalesce(translate(regexp_extract(url, '{URL}', 1), '{UPPER}', '{LOWER}'), '') AS host,
  coalesce(regexp_extract(url, '{URL}', 2), '') AS path FROM pages),
f AS MATERIALIZED (SELECT *, (SELECT max_by(struct_pack(rule := h || p, verdict := verdict), 1000 * length(h || p) + length(h)) FROM rules
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS found FROM u),
g AS (SELECT host, CASE WHEN 2 * count(*) FILTER (found.verdict = 'allow') > count(*) THEN 'trust'
  WHEN 2 * count(*) FILTER (found.verdict = 'block') > count(*) THEN 'distrust' END AS kind FROM f WHERE host <> '' GROUP BY host),
links AS (SELECT DISTINCT src, dst FROM (SELECT host AS src, translate(unnest(regexp_extract_all(html, '{href}', 1)), '{UPPER}', '{LOWER}') AS dst
  FROM u WHERE host <> '') WHERE src <> dst),
b AS (SELECT 'trust' AS kind, src, dst FROM links UNION ALL SELECT 'distrust', dst, src FROM links),
e AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY kind, src) AS fan FROM b),
m0 AS MATERIALIZED (SELECT kind, host, {UNIT}::BIGINT // count(*) OVER (PARTITION BY kind) AS mass FROM g WHERE kind IS NOT NULL){steps},
t AS MATERIALIZED (SELECT host, coalesce(sum(mass) FILTER (kind = 'trust'), 0)::HUGEINT AS trust, coalesce(sum(mass) FILTER (kind = 'distrust'), 0)::HUGEINT AS distrust
  FROM ({' UNION ALL '.join(f'SELECT * FROM m{k}' for k in range(ROUNDS + 1))}) GROUP BY host),
bad AS (SELECT host FROM t WHERE CASE WHEN (SELECT sum(trust) FROM t) = 0 THEN distrust > 0
  ELSE distrust * (SELECT sum(trust) FROM t)::HUGEINT > trust * (SELECT sum(distrust) FROM t)::HUGEINT END)
SELECT page_id, host, path, found.rule AS rule,
  coalesce(found.verdict, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict FROM f
"""


ORACLE["op12_link_trust"] = _op12_oracle()


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quakehouse.llm import periodic_runs

    # the contract's texts: every tenth document (by checksum) becomes periodic from word a on; a null id leaves its text
    # (the lists of words exist only for those)
    h = F.crc32(F.col("doc_id").cast("string"))
    docs = (table(spark, sf_dir, "documents").select("doc_id", "text", h.alias("h"))
            .withColumn("words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0)))
            .withColumn("n", F.coalesce(F.size("words"), F.lit(0)).cast("long"))
            .withColumn("a", F.when(F.col("n") > 0, F.expr("(h div 10) % n")))
            .withColumn("p", F.expr("1 + (n - a) div (3 + (h div 10) % 8)"))
            .select("doc_id", F.expr("""CASE WHEN n > 0 THEN concat_ws(' ', transform(sequence(0L, n - 1),
                i -> words[int(IF(i < a, i, a + (i - a) % p))])) ELSE text END""").alias("text")))
    found = periodic_runs.find_runs(docs)
    best = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')))")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query("op11_sketch_search")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quakehouse.llm import lexical_search

    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op11_sketch_search"] = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
len AS MATERIALIZED (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
stat AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM len),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
weight AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
           FROM tf, stat WHERE term IN (SELECT term FROM asked) GROUP BY term),
scored AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
           FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN len USING (doc_id), stat GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
