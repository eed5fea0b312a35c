"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.session import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest reachable node) for every node of ``edges`` (a, b longs).

    Alternating star contraction: the large step hangs a node's larger neighbours
    on its least neighbour, the small step does so with the smaller ones, until
    all edges are stars. Every step is a minimum and a join, so a node with a
    third of all edges is no group anywhere; each round is written to the shared folder.
    """
    now = materialise(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialise(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = materialise(small.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        after = _state(now)
        if after == state:
            break
        state = after
    ends = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
