"""Connected components by alternating stars, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeline.llm.tables import discard, store


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars around smallest nodes: none has two centres or is one and has one."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("hooked"), F.lit(0).alias("centre")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("hooked"), F.lit(1).alias("centre")))
    roles = ends.groupBy("node").agg(F.sum("hooked").alias("hooked"), F.max("centre").alias("centre"))
    return roles.filter("hooked + centre > 1").isEmpty()


def oriented(links: DataFrame) -> DataFrame:
    """The links (a, b) as stored edges (u, v) with u > v, each once."""
    return store(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "links")


def hooked(edges: DataFrame) -> DataFrame:
    """The edges after one round, stored; those given are deleted.

    The large star moves higher neighbours of a node to the smallest it knows, the small
    star lower ones. What was connected stays so and nothing else becomes so.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    small = large.join(_least(large), "u").select("u", "v", "m")
    after = store(
        small.select(F.col("u"), F.col("m").alias("v")).unionByName(
            small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(), "links")
    discard(edges)
    return after


def labels(edges: DataFrame) -> DataFrame:
    """node, component of every node of the edges: the smallest node each is hooked to.

    Nodes of one label are connected; connected ones have one label once the edges are settled."""
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))


def settled(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node of the edges, hooked until they are stars."""
    while not _settled(edges):
        edges = hooked(edges)
    return labels(edges)


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node with a link.

    ``links``: two long columns a, b. Each round hooks every node to the smallest
    neighbour it knows until the edges are stars. A round is a pre-aggregated minimum
    and a join; each is written to the shared folder and its lineage ends there.
    """
    return settled(oriented(links))
