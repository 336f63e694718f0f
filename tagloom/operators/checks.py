"""Table constraints as operators that part good rows from bad ones.

Each function is lazy. A bad row never takes other rows with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators.keys import one_per_key
from tagloom.schemas import HASHTAG_LENGTH
from tagloom.sources.tables import shared_dir

BROADCAST_ROWS = 250_000  # of an id and a place, some 50 MB


def _reasons(*rules: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*(F.when(broken, F.lit(reason)) for broken, reason in rules)))


def _misfit(name: str) -> Column:
    return F.col(name).isNull() & F.col(f"raw_{name}").isNotNull()


def check_tweets(tweets: DataFrame) -> DataFrame:
    """Adds ``reasons``: why a row of ``unpack_tweets`` cannot be stored (or empty)."""
    return tweets.withColumn(
        "reasons",
        _reasons(
            (F.col("raw_tweet_id").isNull(), "tweet_id missing"),
            (_misfit("tweet_id"), "tweet_id does not fit"),
            (F.col("raw_author_id").isNull(), "author_id missing"),
            (_misfit("author_id"), "author_id does not fit"),
            (_misfit("conversation_id"), "conversation_id does not fit"),
            (_misfit("created_at"), "created_at does not fit"),
        ),
    )


def check_hashtags(hashtags: DataFrame) -> DataFrame:
    """Adds ``reasons`` to rows of ``hashtags``."""
    return hashtags.withColumn(
        "reasons",
        _reasons(
            (F.col("tweet_id").isNull(), "tweet_id missing"),
            (F.col("hashtag").isNull(), "hashtag missing"),
            (F.char_length("hashtag") > HASHTAG_LENGTH, "hashtag does not fit"),
        ),
    )


def split_checked(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without and rows with reasons."""
    good = checked.where(F.size("reasons") == 0).drop("reasons")
    return good, checked.where(F.size("reasons") > 0)


def broadcast_if_small(side: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a join side for broadcast if a count proves it to be small.

    Runs a job and keeps its result as a checkpoint. A larger side is returned
    without a hint, for a shuffle join.
    """
    shared_dir(side.sparkSession)
    side = side.checkpoint()
    return F.broadcast(side) if side.count() <= rows else side


def mark_duplicates(
    new: DataFrame,
    stored: DataFrame | None = None,
    key: str = "tweet_id",
    order: tuple[str, ...] = ("file", "pos"),
    sized: bool = False,
) -> DataFrame:
    """Adds ``is_duplicate``: the id came earlier in ``new`` or is in ``stored``.

    ``order`` must be unique within an id; the row that comes first stays. Rows
    with a null id are never duplicates. The first position per id is an
    aggregate (combined before the shuffle) of which only repeated ids are
    joined back, so one id on a large part of the rows stays harmless: the
    join's small side has one row per id and the other side may be split.

    With ``sized`` the (usually few) repeated ids are found by a job of their own,
    so that wide rows need no shuffle if they prove small enough to broadcast.
    """
    place = F.struct(*order)
    known = new.where(F.col(key).isNotNull())
    places = known.select(key, place.alias("_place"), F.lit(False).alias("_stored"))
    if stored is not None:
        # Of the stored ids only those matter that come again.
        again = stored.select(key).join(known.select(key).distinct(), key, "left_semi")
        stored_places = again.select(
            key,
            F.lit(None).cast(places.schema["_place"].dataType).alias("_place"),
            F.lit(True).alias("_stored"),
        )
        places = places.unionByName(stored_places)
    marks = one_per_key(
        places,
        key,
        F.min("_place").alias("_first"),
        F.count("_place").alias("_rows"),
        F.bool_or("_stored").alias("_stored"),
    )
    marks = marks.where((F.col("_rows") > 1) | F.col("_stored")).drop("_rows")
    if sized:
        marks = broadcast_if_small(marks)
    is_duplicate = F.coalesce(F.col("_stored") | (place > F.col("_first")), F.lit(False))
    return (
        new.join(marks, key, "left")
        .withColumn("is_duplicate", is_duplicate)
        .select(*new.columns, "is_duplicate")
    )


def split_duplicates(
    new: DataFrame,
    stored: DataFrame | None = None,
    key: str = "tweet_id",
    order: tuple[str, ...] = ("file", "pos"),
) -> tuple[DataFrame, DataFrame]:
    """Rows to keep and rows rejected as duplicates."""
    marked = mark_duplicates(new, stored, key, order)
    return (
        marked.where(~F.col("is_duplicate")).drop("is_duplicate"),
        marked.where("is_duplicate").drop("is_duplicate"),
    )


def orphan_hashtags(hashtags: DataFrame, tweets: DataFrame) -> DataFrame:
    """Hashtag rows whose post is not in ``tweets``."""
    return hashtags.join(tweets.select("tweet_id"), "tweet_id", "left_anti")
