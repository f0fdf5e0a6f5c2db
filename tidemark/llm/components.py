"""Connected components of a graph given as an edge table, by alternating star contractions.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014): a large-star step hangs the
larger neighbours of a node onto its smallest one, a small-star step does so with the smaller ones,
until every node hangs on the smallest node of its component. Each step is a partial aggregate and an
equi-join on the node, so a hub is one row of the aggregate and a skewed join that AQE splits. Every
round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import written


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node that has an edge; ``root`` is the smallest node it reaches.

    Nulls and loops are no edges; repeated and turned edges count once; no edges give an empty table.
    """
    ends = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    state = written(ends.distinct(), "components")
    before = _signature(state)
    while before[0]:
        state = written(_small_star(_large_star(state)), "components")
        now = _signature(state)
        if now == before:
            break
        before = now
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
