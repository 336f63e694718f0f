"""The table of batches and their processing status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.schemas import RELEASED, STATUSES


def upsert_batches(batches: DataFrame, names: DataFrame) -> DataFrame:
    """Register ``names`` (batch_name): insert as NEW, or set back to NEW."""
    fresh = names.select("batch_name").distinct().withColumn("batch_status", F.lit("NEW"))
    return batches.join(fresh, "batch_name", "left_anti").unionByName(fresh)


def set_status(batches: DataFrame, name: str, status: str) -> DataFrame:
    """Set the status of one batch; an unknown name changes nothing."""
    if status not in STATUSES:
        raise ValueError(f"unknown status {status!r}")
    return batches.withColumn(
        "batch_status",
        F.when(F.col("batch_name") == name, F.lit(status)).otherwise(F.col("batch_status")),
    )


def release_batch(tweets: DataFrame, name: str) -> DataFrame:
    """Take the batch name off the posts of a batch that succeeded."""
    return tweets.withColumn(
        "batch_name",
        F.when(F.col("batch_name") == name, F.lit(RELEASED)).otherwise(F.col("batch_name")),
    )
