"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.stage import cut


def _large(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the smallest node around it: ``u`` to the smallest parent of its ``v``, or to ``v``."""
    low = e.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
    return e.join(low, "v", "left").select("u", F.coalesce("m", "v").alias("v"))


def _small(e: DataFrame) -> DataFrame:
    """``u`` and its smaller neighbours point to the smallest of them."""
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    return e.join(low, "u").select(F.when(F.col("v") > F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))


def _stars(e: DataFrame) -> bool:
    """Whether every ``u`` of the distinct edges has one ``v`` and is no ``v`` itself."""
    up = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    down = e.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    nodes = up.unionByName(down).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up + down > 1").agg(F.count("*")).first()[0] == 0


def connected(edges: DataFrame) -> DataFrame:
    """``(node, comp)`` for every node of ``edges`` (``u``, ``v``); ``comp`` is its smallest node.

    ``u`` is the larger node of every edge throughout.  Each round is two
    aggregates and two joins on the edges, written to the checkpoint folder;
    rounds end when every component is a star around its smallest node (after
    about the logarithm of the longest path), which is tested before each, so
    that none runs only to find nothing to change.  Nothing but a count reaches
    the driver.
    """
    e = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _stars(e):
        e = cut(_small(_large(e).distinct()).distinct(), "edges")
    leaves = e.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return leaves.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
