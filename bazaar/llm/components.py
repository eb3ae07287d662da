"""Connected components of an edge table, without collecting any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep


def _toward_min(edges: DataFrame, upper_only: bool) -> DataFrame:
    """Each vertex u links its neighbours (``upper_only``: the larger ones,
    else the smaller ones and itself) to the least vertex near u."""
    if upper_only:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    else:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = near.join(low, "u")
    out = linked.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")) if upper_only else \
        linked.select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select("u", "m"))
    return out.filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node on an edge of ``edges`` (a long, b long):
    ``root`` is the least node of its component.  Alternating star
    contractions: every round is two aggregations and two joins on a vertex,
    the number of rounds grows with the logarithm of the longest path.
    Self loops, repeated and reversed edges do no harm; no edges, no rows."""
    edges = keep(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .distinct(), "edges")
    while not _stars(edges):
        edges = keep(_toward_min(keep(_toward_min(edges, True), "edges"), False), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b"), F.col("b"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every edge (larger a, lesser b) leads to the end: each a has one
    b, and no b is an a."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("low"), F.lit(0).alias("high")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    open_ = ends.groupBy("node").agg(F.sum("low").alias("low"), F.sum("high").alias("high")).filter(
        "low > 1 OR (low > 0 AND high > 0)")
    return open_.isEmpty()


def merged(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``parts`` (node, root) after further ``links`` (a, b): only the roots that
    the links join are contracted, a graph far smaller than the first.  Nodes
    that are in no part yet stand for themselves."""
    named = parts.withColumnRenamed("node", "a").withColumnRenamed("root", "ra")
    other = parts.withColumnRenamed("node", "b").withColumnRenamed("root", "rb")
    joined = links.join(named, "a", "left").join(other, "b", "left").select(
        F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    roots = components(joined).withColumnRenamed("root", "new").withColumnRenamed("node", "root")
    alone = roots.join(parts.select(F.col("node").alias("root")), "root", "left_anti")
    return (parts.join(roots, "root", "left").select("node", F.coalesce("new", "root").alias("root"))
            .union(alone.select(F.col("root").alias("node"), F.col("new").alias("root"))))
