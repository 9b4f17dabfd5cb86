"""Links and components from inverted lists, without all pairs of a list.

A list holds the nodes that share a key. Comparing all its pairs would grow with
its square, so each round compares every node of a list with a few pivots only.
Nodes linked to a pivot are in its component, and nothing inside a component
needs another comparison. Pivots leave the list (all their pairs are settled),
lists with one component left end, and the next round goes on. Pivots come from
the smallest components: a large group keeps its members, and each straggler is
settled against all of it at once. The first round has one pivot a list, later
ones as many as keep a round's comparisons within a fixed multiple of the lists'
rows. Once what is left is within that multiple too, the remaining pairs between
different components are compared one by one. No pair whose link could change a
component is left out, so the components are those of all links.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from quakehouse.session import materialize

#: pivots of a list in one round; the rest follow in later rounds
MOST_PIVOTS = 64


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of an undirected edge list (a, b): the smallest node reachable.

    Alternating large-star and small-star steps; each is one grouped minimum and one join.
    """
    current = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                          .filter("u <> v").distinct(), "components")
    mark = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large.filter("u <> v"), "components")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        current = materialize(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                              .unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "components")
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    return (current.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


def resolve(lists: DataFrame, links: Callable[[DataFrame], DataFrame], slack: int = 8, percent: int = 0,
            shared: bool = False) -> DataFrame:
    """Edges (a, b) whose components are those of all linked pairs that share a key of ``lists`` (key, node[, size]).

    ``links`` takes distinct pairs (a, b), a < b, and returns those that are linked; nodes whose sizes are less than
    ``percent`` of each other cannot be. ``shared`` says that the rows are distinct and each key has two or more.
    A round compares at most about ``slack`` times the rows of all lists.
    """
    spark = lists.sparkSession
    if "size" not in lists.columns:
        lists = lists.withColumn("size", F.lit(1).cast("long"))
    if not shared:
        lists = lists.distinct()
        lists = materialize(lists.join(lists.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "key"), "lists")
    lists = lists.withColumn("component", F.col("node"))

    def sized(x: str, y: str):
        return 100 * F.least(x, y) >= percent * F.greatest(x, y)

    edges, enough, first = spark.createDataFrame([], "a long, b long"), slack * lists.count(), True
    while True:
        parts = lists.groupBy("key", "component").agg(F.count("*").alias("k"), F.min(F.struct("node", "size")).alias("first")).select(
            "key", "component", "k", F.col("first.node").alias("pivot"), F.col("first.size").alias("pivot_size"))
        sizes = (parts.groupBy("key").agg(F.sum("k").alias("n"), F.sum(F.col("k") * F.col("k")).alias("within"), F.count("*").alias("parts"))
                 .filter("parts > 1"))
        rows, left = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum((F.col("n") * F.col("n") - F.col("within")) / 2), F.lit(0))).first()
        if not rows:
            return edges
        last = left <= enough and not first
        lists = lists.join(sizes.select("key"), "key")
        if last:
            x, y = lists.alias("x"), lists.alias("y")
            pairs = x.join(y, "key").filter("x.node < y.node and x.component <> y.component").filter(sized("x.size", "y.size")).select(
                F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        else:
            # limited before the shuffle, so a list with very many components is no hot task
            pivots = (parts.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy("k", "pivot")))
                      .filter(F.col("place") <= (1 if first else max(1, min(MOST_PIVOTS, enough // rows))))
                      .select("key", "pivot", "pivot_size", F.col("component").alias("of")))
            pivots = materialize(pivots, "pivots")
            pairs = lists.join(pivots, "key").filter("component <> of").filter(sized("size", "pivot_size")).select(
                F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
        # written first, so the planner knows whether few enough are left to broadcast
        found = materialize(links(materialize(pairs.distinct(), "pairs")).select("a", "b"), "links")
        grown = not found.isEmpty()
        if grown:
            edges = materialize(edges.unionByName(found), "edges")
        if last:
            return edges
        first = False
        lists = lists.join(pivots.select("key", F.col("pivot").alias("node")), ["key", "node"], "left_anti")
        if grown:
            lists = (lists.select("key", "node", "size").join(components(edges), "node", "left")
                     .select("key", "node", "size", F.coalesce("component", "node").alias("component")))
        lists = materialize(lists, "lists")
