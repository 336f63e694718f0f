"""Hashtags with their posts, and the co-occurrence network."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.keys import one_per_key
from tagloom.operators.sizes import lean_shuffles


def fetch_hashtags(
    hashtags: DataFrame,
    tweets: DataFrame,
    batch: str | None = None,
    from_date: str | date | datetime | None = None,
    to_date: str | date | datetime | None = None,
) -> DataFrame:
    """Hashtags joined to their posts; dates are inclusive, falsy means no filter."""
    lean_shuffles(hashtags)
    posts = tweets.select("tweet_id", "author_id", "created_at", "batch_name")
    if batch:
        posts = posts.where(F.col("batch_name") == batch)
    if from_date:
        posts = posts.where(F.col("created_at") >= F.lit(from_date).cast("timestamp_ntz"))
    if to_date:
        posts = posts.where(F.col("created_at") <= F.lit(to_date).cast("timestamp_ntz"))
    return hashtags.select("tweet_id", "hashtag").join(posts, "tweet_id", "inner")


def multi_hashtag(hashtags: DataFrame) -> DataFrame:
    """Rows of posts that have more than one hashtag row."""
    several = one_per_key(hashtags, "tweet_id", F.count("*").alias("rows")).where("rows > 1")
    return hashtags.join(several, "tweet_id", "left_semi")


def hashtag_sets(hashtags: DataFrame) -> DataFrame:
    """Per post its different lower-cased hashtags, sorted; at least two.

    Sets are built before the shuffle, so repeats never travel. The row of a
    post holds its set, as this is the result asked for; the network itself
    (:func:`cooccurrence`) is counted without such rows.
    """
    sets = hashtags.groupBy("tweet_id").agg(
        F.array_sort(F.collect_set(F.lower("hashtag"))).alias("hashtags")
    )
    return sets.where(F.size("hashtags") > 1)


def set_pairs(sets: DataFrame) -> DataFrame:
    """Pairs (hashtag1 < hashtag2) of each sorted set, within the row."""
    last = F.size("hashtags") - 1
    firsts = sets.select("tweet_id", "hashtags", F.posexplode("hashtags").alias("i", "hashtag1"))
    pairs = firsts.where(F.col("i") < last).select(
        "tweet_id",
        "hashtags",
        "hashtag1",
        F.explode(F.sequence(F.col("i") + 1, last)).alias("j"),
    )
    return pairs.select("tweet_id", "hashtag1", F.get("hashtags", F.col("j")).alias("hashtag2"))


def hashtag_pairs(hashtags: DataFrame) -> DataFrame:
    """Unordered pairs of different hashtags of a post, once per post.

    A join of the distinct (post, hashtag) rows with themselves on the post.
    Nothing is collected: the distinct step combines repeats before its shuffle,
    both sides of the join read the same shuffle, and adaptive execution splits
    a post that holds a large part of the rows. The distinct rows are structs, so
    that where ``hashtags`` come from a join on the post, they are shuffled anew:
    else that join would run twice, in the task that joins the rows with themselves.
    """
    lean_shuffles(hashtags)
    tags = hashtags.select(F.struct("tweet_id", F.lower("hashtag").alias("tag")).alias("_row"))
    tags = tags.distinct().select("_row.*")
    # Names are given after the join: with equal sides the shuffle is shared.
    pairs = tags.alias("x").join(tags.alias("y"), "tweet_id").where("x.tag < y.tag")
    return pairs.select(
        "tweet_id", F.col("x.tag").alias("hashtag1"), F.col("y.tag").alias("hashtag2")
    )


def cooccurrence(hashtags: DataFrame) -> DataFrame:
    """Weight of a pair = number of posts that have both hashtags."""
    pairs = hashtag_pairs(hashtags)
    return pairs.groupBy("hashtag1", "hashtag2").agg(F.count(F.lit(1)).alias("weight"))
