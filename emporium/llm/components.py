"""Connected components of a link table, as Spark joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.llm.common import cut, spent


def _smallest(links: DataFrame) -> DataFrame:
    """Every neighbour pair (u, v) both ways with the smallest of u and u's neighbours."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    return both.join(least, F.col("u") == F.col("k")).select("u", "v", "m")


def _tidy(links: DataFrame) -> DataFrame:
    return links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(spark: SparkSession, links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for all nodes of ``links(a, b)``, written to the shared
    folder; a component is named by its smallest node.

    Every node steps to the smallest of itself and its neighbours, and links are
    then links of the nodes stepped to: a component stays connected and keeps
    its smallest node, and most are that one node after a step or two. Steps are
    taken while at most half of the links remain after one; the rest, paths in
    the order of their nodes, goes through ``_stars``. A node is in the component
    of the node it steps to. Groupings are minima only (combined before the
    shuffle), so a node with very many links costs no task all of them. Null
    ends and self-links are ignored."""
    now = cut(spark, _tidy(links.select("a", "b")), "links")
    count, steps, halved = now.count(), [], True
    while count and halved:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        steps.append(cut(spark, both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("to")), "step"))
        ends = [steps[-1].select(F.col("node").alias(f"n{c}"), F.col("to").alias(f"t{c}")) for c in "ab"]
        moved = now.join(ends[0], F.col("a") == F.col("na")).join(ends[1], F.col("b") == F.col("nb")).select(F.col("ta").alias("a"), F.col("tb").alias("b"))
        before, now = now, cut(spark, _tidy(moved), "left")
        spent(before)
        left = now.count()
        count, halved = left, 2 * left <= count
    part = cut(spark, _stars(spark, now, max_rounds) if count else now.select(F.col("b").alias("node"), F.col("a").alias("component")), "part")
    for step in reversed(steps):
        before, part = part, cut(spark, step.join(part.select(F.col("node").alias("k"), "component"), F.col("to") == F.col("k"), "left")
                                 .select("node", F.coalesce("component", "to").alias("component")), "part")
        spent(before, step)
    return part


def _stars(spark: SparkSession, now: DataFrame, max_rounds: int) -> DataFrame:
    """(node, component) of tidy links.

    Alternates two steps until nothing changes: every node ties its larger
    neighbours to its smallest neighbour, then its smaller ones. The rounds
    grow with the logarithm of the longest path; each is written to the shared
    folder."""
    print_of = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    state = print_of(now)
    for _ in range(max_rounds):
        large = _smallest(now).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        before, now = now, cut(spark, _tidy(large), "large")
        spent(before)
        # links now point from a node to smaller ones: a < b after tidy, so b's smaller neighbours are its a's
        least = now.groupBy("b").agg(F.min("a").alias("m")).withColumnRenamed("b", "k")
        small = now.join(least, F.col("b") == F.col("k"))
        before, now = now, cut(spark, _tidy(small.select("a", F.col("m").alias("b")).union(small.select(F.col("k"), "m"))), "small")
        spent(before)
        seen = print_of(now)
        if seen == state:
            break
        state = seen
    else:
        raise RuntimeError(f"components: links still move after {max_rounds} rounds")
    member = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return member.union(now.select(F.col("a"), F.col("a")).distinct())
