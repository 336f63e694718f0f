"""From hashtags and posts to the co-occurrence table."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame

from tagloom.operators.hashtags import cooccurrence, fetch_hashtags


def hashtag_network(
    hashtags: DataFrame,
    tweets: DataFrame,
    batch: str | None = None,
    from_date: str | date | datetime | None = None,
    to_date: str | date | datetime | None = None,
) -> DataFrame:
    """Co-occurrence of the hashtags of one batch or period (or of all posts)."""
    return cooccurrence(fetch_hashtags(hashtags, tweets, batch, from_date, to_date))


def rebuild_network(hashtags: DataFrame, tweets: DataFrame, path: str) -> None:
    """Compute the whole table anew and replace what is stored.

    The alternative to adding deltas: it cannot count a post twice.
    """
    hashtag_network(hashtags, tweets).write.mode("overwrite").parquet(path)
