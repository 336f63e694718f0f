"""Node and edge tables of the hashtag network."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.schemas import EDGE_LAYER


def network_edges(cooccurrence: DataFrame, layer: str = EDGE_LAYER) -> DataFrame:
    """Edge list of the one-layer network."""
    return cooccurrence.select(
        F.col("hashtag1").alias("from_actor"),
        F.lit(layer).alias("from_layer"),
        F.col("hashtag2").alias("to_actor"),
        F.lit(layer).alias("to_layer"),
        "weight",
    )


def network_vertices(edges: DataFrame) -> DataFrame:
    """Actors of the network, each with its layer."""
    ends = edges.select(
        F.explode(
            F.array(
                F.struct(F.col("from_actor").alias("actor"), F.col("from_layer").alias("layer")),
                F.struct(F.col("to_actor").alias("actor"), F.col("to_layer").alias("layer")),
            )
        ).alias("end")
    )
    return ends.select("end.actor", "end.layer").distinct()
