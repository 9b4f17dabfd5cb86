import random
import re

import duckdb
import pytest

from quakehouse.llm import link_trust
from quakehouse.llm.queries import ORACLE, QUERIES, URL_RULES

SF = "/root/testdata/sf0.01"


def brute(rows):
    """Plain dictionaries: rules, seeds, rounds of integer masses, verdicts."""
    def fit(host, path):
        got = [(len(h + p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(got)[1:] if got else (None, None)
    seen, votes, links = [], {}, set()
    for i, url, html in rows:
        host, path = "", ""
        if url is not None and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest).group()
            path = re.match(r"[^?#]*", rest[len(host):]).group()
            host = "".join(c.lower() if c.isascii() else c for c in host)
        rule, verdict = fit(host, path)
        seen.append((i, host, path, rule, verdict))
        if host:
            votes.setdefault(host, []).append(verdict)
            for x in re.findall(r"""(?i)\shref=["']?(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"'>\s]+)""", html or ""):
                if x.lower() != host:
                    links.add((host, x.lower()))
    total, masses = {}, {}
    for kind, verdict, edges in (("trust", "allow", links), ("distrust", "block", {(b, a) for a, b in links})):
        out = {}
        for a, b in edges:
            out.setdefault(a, []).append(b)
        seeds = [h for h, v in votes.items() if 2 * v.count(verdict) > len(v)]
        now = {h: 10**15 // len(seeds) for h in seeds}
        every = dict(now)
        for _ in range(20):
            nxt = {}
            for h, m in now.items():
                for b in out.get(h, []):
                    nxt[b] = nxt.get(b, 0) + (m * 85 // 100) // len(out[h])
            now = nxt
            for h, m in now.items():
                every[h] = every.get(h, 0) + m
        masses[kind], total[kind] = every, sum(every.values())

    def bad(h):
        d, t = masses["distrust"].get(h, 0), masses["trust"].get(h, 0)
        return d * total["trust"] > t * total["distrust"] if total["trust"] else d > 0
    return sorted(((i, h, p, r, v or ("block" if h and bad(h) else "allow")) for i, h, p, r, v in seen), key=str)


def made(n=400):
    rnd = random.Random(5)
    hosts = [f"{w}{i}.{d}" for i in range(12) for w, d in (("a", "example.org"), ("B", "Example.net"), ("www.c", "example.com"), ("d", "test.io"))] + ["www.example.com"]
    rows = []
    for i in range(n):
        url = f"http://{rnd.choice(hosts[:30]) if rnd.random() < .7 else hosts[0]}/{rnd.choice(['en', 'es', 'fr', 'de'])}/{i}{rnd.choice(['', '?q=http://x.org/', '#t'])}"
        html = "<p>" + " ".join(f'<a {rnd.choice(["href", "HREF"])}={rnd.choice(["http:", "HTTPS:", ""])}//{rnd.choice(hosts)}/x>y</a>' for _ in range(rnd.randrange(4)))
        rows.append((i, url, html))
    return rows + [(None, None, None), (900, "", ""), (901, "no scheme", None), (902, "http://a.com", ""), (902, "http://a.com", ""),
                   (903, "http://É.net/fr/x", "<a href='//a0.example.org'>"), (904, "http://host.net?x=/fr/", "x" * 300_000 + ' href="http://d1.test.io">')]


def test_against_brute_force_and_sql(spark):
    rows = made()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'z' AS host", "1 AS kind", "2 AS mass", "'a' AS found")
    got = sorted((tuple(r) for r in link_trust.judge(df, URL_RULES).collect()), key=str)
    want = brute(rows)
    assert got == want
    assert {v for _, _, _, r, v in want if r is None} == {"allow", "block"}
    con = duckdb.connect()
    con.register("pages", df.toPandas())
    assert sorted(con.execute(ORACLE["op12_link_trust"]).fetchall(), key=str) == want


def test_contract_table_and_empty(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = sorted((tuple(r) for r in QUERIES["op12_link_trust"](spark, SF).collect()), key=str)
    assert got == brute([(r.page_id, r.url, r.html) for r in pages.collect()])
    assert link_trust.judge(pages.limit(0), URL_RULES).count() == 0


@pytest.mark.parametrize("url, host, path", [("x://a/b://c/d", "a", "/b://c/d"), ("http://U:p@H:80#/x", "u:p@h:80", ""), ("://", "", "")])
def test_urls(spark, url, host, path):
    r = spark.createDataFrame([(url,)], "u string").select(link_trust.host_of("u").alias("h"), link_trust.path_of("u").alias("p")).first()
    assert (r.h, r.p) == (host, path)
