"""Aggregates that are joined back to the rows they come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_per_key(rows: DataFrame, key: str, *aggregates: Column) -> DataFrame:
    """One row per ``key`` with the given aggregates, as the small side of a join.

    A frequent key is harmless here, as rows are combined before the shuffle. In
    the join it is harmless only if adaptive execution may split it, which it does
    between two shuffles made for the join. Grouping by the key within a struct
    leaves the result without a partitioning by the key, so there is such a
    shuffle (of one row per key).
    """
    grouped = rows.groupBy(F.struct(key).alias("_key")).agg(*aggregates)
    others = [c for c in grouped.columns if c != "_key"]
    return grouped.select(F.col("_key").getField(key).alias(key), *others)
