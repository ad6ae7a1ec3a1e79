"""Connected components of a graph of links, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspan.operators.lookup import BROADCAST_BYTES, ROW_OVERHEAD_BYTES, lookup
from panelspan.sinks.scratch import staged

NODE_BYTES = ROW_OVERHEAD_BYTES + 16


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it is connected with) of links (a, b).

    Large-star and small-star steps in turn, until every link is one with a root; the
    number of links never grows. Each round is written, so a lost executor costs none. Where
    the nodes do not fit a broadcast, the links of a node with very many are spread by their
    other end.
    """
    links = staged(_ordered(links))
    state = _state(links)
    while True:
        # There are at most two nodes to a link, and the number of links never grows.
        small = 2 * state[0] * NODE_BYTES <= BROADCAST_BYTES
        links = staged(_small_star(_large_star(links, small), small))
        before, state = state, _state(links)
        if state == before:
            break
    nodes = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    roots = links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return nodes.union(roots)


def _ordered(links: DataFrame) -> DataFrame:
    return (
        links.filter("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(links: DataFrame, small: bool) -> DataFrame:
    """Each larger neighbour of a node is linked with the smallest one."""
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        lookup(both, least, "u", "inner", small, spread_by=["v"])
        .filter("v > u")
        .select(F.col("m").alias("a"), F.col("v").alias("b"))
        .filter("a <> b")
        .distinct()
    )


def _small_star(links: DataFrame, small: bool) -> DataFrame:
    """Each smaller neighbour of a node, and the node, are linked with the smallest one."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    joined = lookup(links, least, "b", "inner", small, spread_by=["a"])
    around = joined.select(F.col("m").alias("a"), F.col("a").alias("b")).filter("a <> b")
    return around.union(least.select(F.col("m").alias("a"), "b")).distinct()

