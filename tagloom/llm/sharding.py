"""Shards by a hierarchical weighted hash tree, in DataFrame operations only.

A document descends region, rack and shard. At each level every child draws
``-ln(u) / weight`` with ``u`` a hash of the document and the child, and the
smallest draw wins: an exponential race, so children win in proportion to their
weights. A child's draw depends on nothing but the document, the child and its
weight. So if the weight of a subtree changes, documents only move into it or
out of it, and what stays outside keeps its place.

A tree is ``{region: {rack: {shard: weight}}}``; a subtree weighs what its
shards weigh. :func:`hash_tree` puts each shard beyond the first ``base`` in a
region of its own: no other weight changes, so it takes documents only into
itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import hash52, running, spread, text_or_empty

Tree = dict[str, dict[str, dict[int, float]]]


def hash_tree(shards: int, base: int = 8, fanout: int = 2) -> Tree:
    """The tree of so many shards, of weight 1 each.

    The first ``base`` shards lie in racks of ``fanout`` and regions of
    ``fanout`` racks; every further shard is a region.
    """
    tree: Tree = {}
    for shard in range(shards):
        rack = f"k{shard // fanout}" if shard < base else f"k-{shard}"
        region = f"r{shard // fanout**2}" if shard < base else f"r-{shard}"
        tree.setdefault(region, {}).setdefault(rack, {})[shard] = 1.0
    return tree


def _race(key: Column, weights: dict[str, float]) -> Column:
    """The name of the child that wins the race."""
    draws = [
        F.struct(
            (-F.log((hash52(key, name) + F.lit(0.5)) / F.lit(float(2**52))) / F.lit(float(weight))).alias("draw"),
            F.lit(name).alias("name"),
        )
        for name, weight in weights.items()
        if weight > 0
    ]
    return F.array_min(F.array(*draws))["name"]


def _weight(subtree: dict | float) -> float:
    return sum(map(_weight, subtree.values())) if isinstance(subtree, dict) else subtree


def _choose(level: str, tree: dict[str, Tree | dict], key: Column) -> Column:
    """Race among the children of the node whose name is in ``level``."""
    choice = F.lit(None).cast("string")
    for name, children in tree.items():
        weights = {str(child): _weight(below) for child, below in children.items()}
        if any(weights.values()):
            choice = F.when(F.col(level) == name, _race(key, weights)).otherwise(choice)
    return choice


def descend(docs: DataFrame, tree: Tree, key: str = "doc_id", prefix: str = "") -> DataFrame:
    """Add region, rack and shard (names with ``prefix``) that a document's key leads to.

    Rows of one key go together; null keys are one key.
    """
    at = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    region, rack, shard = (f"{prefix}{x}" for x in ("region", "rack", "shard"))
    racks = {name: below for racks in tree.values() for name, below in racks.items()}
    return (
        docs.withColumn(region, _race(at, {name: _weight(below) for name, below in tree.items()}))
        .withColumn(rack, _choose(region, tree, at))
        .withColumn(shard, _choose(rack, racks, at).cast("int"))
    )


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, region, rack, shard, slot, grown_shard: a row per document.

    ``slot`` counts the documents of a shard from 0 in the order of doc_id (null
    first; repeated ids in any order). ``grown_shard`` is the shard with one
    more. Null text has size 1 and the checksum of an empty one.
    """
    sized = docs.select(
        "doc_id",
        (F.octet_length(text_or_empty()) + 1).cast("long").alias("size"),
        F.crc32(text_or_empty().cast("binary")).alias("text_crc32"),
    )
    placed = descend(descend(spread(sized, "doc_id"), hash_tree(shards)), hash_tree(shards + 1), prefix="grown_")
    return running(placed, F.lit(1), "slot", "shard").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "region", "rack", "shard", "slot", "grown_shard"
    )
