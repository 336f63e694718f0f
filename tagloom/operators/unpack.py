"""Flattening nested posts into the post and the hashtag table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _counter(name: str) -> Column:
    return F.coalesce(F.col(f"post.public_metrics.{name}").try_cast("int"), F.lit(0)).alias(name)


def unpack_tweets(raw: DataFrame, *more: Column) -> DataFrame:
    """Rows of ``tweets``; missing counters are 0, values that do not fit are null.

    Keeps ``file`` and ``pos`` as provenance and the ids as read (``raw_*``), so
    that the checks can tell a missing value from one that does not fit. ``more``
    columns of ``raw`` may follow.
    """
    return raw.select(
        F.col("post.id").try_cast("bigint").alias("tweet_id"),
        F.col("post.conversation_id").try_cast("bigint").alias("conversation_id"),
        F.col("post.author_id").try_cast("bigint").alias("author_id"),
        F.col("post.text").alias("text"),
        _counter("retweet_count"),
        _counter("reply_count"),
        _counter("like_count"),
        _counter("quote_count"),
        F.col("post.created_at").try_cast("timestamp_ntz").alias("created_at"),
        "batch_name",
        "file",
        "pos",
        F.col("post.id").alias("raw_tweet_id"),
        F.col("post.conversation_id").alias("raw_conversation_id"),
        F.col("post.author_id").alias("raw_author_id"),
        F.col("post.created_at").alias("raw_created_at"),
        *more,
    )


def unpack_hashtags(raw: DataFrame, *more: str) -> DataFrame:
    """Rows of ``hashtags``: one per tag, as written, repeats kept; ``more`` columns of ``raw`` may follow."""
    tags = raw.select(
        F.col("post.id").try_cast("bigint").alias("tweet_id"),
        "batch_name",
        "file",
        "pos",
        *more,
        F.posexplode("post.entities.hashtags.tag").alias("tag_pos", "hashtag"),
    )
    return tags.where(F.col("hashtag").isNotNull()).select(
        "tweet_id", "hashtag", "batch_name", "file", "pos", "tag_pos", *more
    )
