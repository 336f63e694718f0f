"""Connected components of a graph of long ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours on its smallest one (or on itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
    return (
        both.where("v > u").join(least, F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its smaller neighbours and itself on the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "_u")
    others = edges.join(least, F.col("u") == F.col("_u")).where("v != m")
    return others.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select(F.col("_u").alias("u"), F.col("m").alias("v"))
    )


def components(edges: DataFrame) -> DataFrame:
    """node, root: for each node of an edge the smallest one of its component.

    ``edges`` has two long columns. The state of each round is a written table;
    rounds end when it stays as it is (its checksum is all the driver sees).
    Smallest neighbours are combined before shuffles, and joins on a node with
    very many edges are left to be split at run time.
    """
    a, b = edges.columns
    state = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    state = staged(state.distinct(), "edges")
    before = None
    while True:
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = now
        state = staged(_small_star(staged(_large_star(state).distinct(), "large-star")).distinct(), "small-star")
