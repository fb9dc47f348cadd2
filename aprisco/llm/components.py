"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aprisco.llm.skew import join_by_counts
from aprisco.sources.shared import cut_lineage


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: neighbours are joined to the smallest one instead of to their centre."""
    own = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:  # every neighbour, larger ones are moved
        both = own.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("m", "u"))
        moved = join_by_counts(both.where("v > u"), least, ["u"], "n").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:  # a > b in every edge after a large step
        least = cut_lineage(own.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
        moved = join_by_counts(own, least, ["u"], "n").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return moved.where("a <> b")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is either a centre or joined to one centre only."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("n")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("n"))
    )
    seen = ends.groupBy("node").agg(F.sum("n").alias("joined"), F.min("n").alias("least"))
    return seen.where("joined > 1 or (joined = 1 and least = 0)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and the smallest node of its component as ``component``, for the nodes of the
    edges (columns ``a`` and ``b``, of any orderable type; nulls and loops are left out).

    Large and small star steps alternate until every component is a star around its smallest
    node. Each step is stored, so a lost executor costs a task, and the neighbours of a centre
    with very many of them stay where they are.
    """
    edges = cut_lineage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    while not _are_stars(edges):
        edges = cut_lineage(_stars(edges, large=True).distinct())
        edges = cut_lineage(_stars(edges, large=False).distinct())
    centres = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)
