"""Op 12: URL verdicts by rules and by trust and distrust that links carry.

A url's longest fitting rule decides. For the other urls the host decides: hosts
of whose pages the rules allow more than half are trusted seeds, hosts of whose
pages they block more than half are blocked seeds. Trust flows from the trusted
seeds along the hosts' links (personalised PageRank); distrust flows from the
blocked seeds against them, from a host to those that link to it. A host is
blocked if its share of all distrust is above its share of all trust.

Only built-in DataFrame expressions. Host edges are distinct pairs, aggregated
before the shuffle, so a host's many pages or a page's many links do not add up.
Masses are integers, rounded down at each step: the sums do not depend on the
order of rows, and a mass too small to be divided ends. A round joins only what
moved in the round before; its result is a table in the shared folder. A host
without outgoing edges hands nothing on; as only shares of the totals are
compared, that equals handing it back to the seeds.

Defined results: a null url, or one without ``://``, has an empty host and path,
fits no rule, takes no part in the graph and is allowed. A rule's path must be a
prefix of the url's, so an empty path fits no rule that ends in a slash. Null
html has no links. Rows are judged one by one, so repeated or null page ids
stay; columns other than the three named are ignored. Hosts that no seed
reaches, and ties, are allowed. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quakehouse.session import materialize

#: (host, path, verdict)
Rule = tuple[str, str, str]
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
HREF = r"""(?i)[\t\n\f\r ]href=["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'> \t\n\f\r]+)"""
#: mass of all seeds of a kind; at 8.5e16 in a product it stays in 64 bits
UNIT = 10**15
#: per cent of a host's mass that its links hand on, and rounds of handing on: what is left after them is under 4 %
DAMPING, ROUNDS = 85, 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column | str) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column | str) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null; equal lengths: the longer host."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Distinct (src, dst) of links between different hosts."""
    links = pages.select(host_of(F.col(url)).alias("src"), F.explode(F.array_distinct(
        F.regexp_extract_all(html, F.lit(HREF), 1))).alias("dst"))
    return (links.withColumn("dst", F.translate("dst", UPPER, LOWER))
            .filter((F.col("src") != "") & (F.col("src") != F.col("dst"))).distinct())


def propagate(seeds: DataFrame, edges: DataFrame, damping: int = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust): integer masses of the hosts that the seeds (kind, host) reach.

    ``kind`` is ``trust`` (along ``edges``) or ``distrust`` (against them); a kind's seeds share UNIT equally.
    """
    seeds = materialize(seeds, "link_seeds")
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst")))
    fan = both.groupBy("kind", "src").agg(F.count("*").alias("fan"))
    both = materialize(both.join(fan, ["kind", "src"]), "link_edges")
    # two kinds, so the counts are two rows
    each = seeds.groupBy("kind").agg(F.expr(f"{UNIT}L div count(*)").alias("mass"))
    moved = [materialize(seeds.join(F.broadcast(each), "kind").select("kind", "host", "mass"), "link_mass")]
    for _ in range(rounds):
        share = F.expr(f"(mass * {damping} div 100) div fan")
        step = (both.join(moved[-1].withColumnRenamed("host", "src"), ["kind", "src"])
                .groupBy("kind", F.col("dst").alias("host")).agg(F.sum(share).alias("mass")).filter("mass > 0"))
        step = materialize(step, "link_mass")
        if step.isEmpty():
            break
        moved.append(step)
    every = moved[0]
    for m in moved[1:]:
        every = every.unionByName(m)
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("mass"))), F.lit(0)).alias(kind)
    return every.groupBy("host").agg(of("trust"), of("distrust"))


def blocked_hosts(masses: DataFrame) -> DataFrame:
    """(host) of those whose share of all distrust is above their share of all trust."""
    masses = materialize(masses, "link_masses")
    wide = lambda c: c.cast("decimal(19,0)")
    total = lambda kind: masses.select(wide(F.coalesce(F.sum(kind), F.lit(0)))).scalar()
    # without any trust at all, distrust alone decides
    return masses.filter(F.when(total("trust") == 0, F.col("distrust") > 0).otherwise(
        wide(F.col("distrust")) * total("trust") > wide(F.col("trust")) * total("distrust"))).select("host")


def judge(pages: DataFrame, rules: list[Rule], page_id: str = "page_id", url: str = "url", html: str = "html",
          damping: int = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages``."""
    ruled = (pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
             .withColumn("found", longest_rule(F.col("host"), F.col("path"), rules)))
    said = lambda v: F.count(F.when(F.col("found.verdict") == v, 1))
    hosts = ruled.filter("host <> ''").groupBy("host").agg(F.count("*").alias("n"), said("allow").alias("allow"), said("block").alias("block"))
    seeds = (hosts.select("host", F.expr("CASE WHEN 2 * allow > n THEN 'trust' WHEN 2 * block > n THEN 'distrust' END").alias("kind"))
             .filter("kind IS NOT NULL").select("kind", "host"))
    bad = blocked_hosts(propagate(seeds, host_edges(pages, url, html), damping, rounds)).select("host", F.lit(True).alias("bad"))
    return ruled.join(bad, "host", "left").select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), F.when(F.col("bad"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))
