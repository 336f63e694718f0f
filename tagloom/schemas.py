"""Schemas of the input envelope and of all tables, in one place."""

from __future__ import annotations

from pyspark.sql import types as T

# Ids and counters arrive quoted or bare. Spark's JSON reader accepts both only
# under a string field, so everything is read as text and cast afterwards.
POST = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("conversation_id", T.StringType()),
        T.StructField("author_id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField(
            "public_metrics",
            T.StructType(
                [
                    T.StructField("retweet_count", T.StringType()),
                    T.StructField("reply_count", T.StringType()),
                    T.StructField("like_count", T.StringType()),
                    T.StructField("quote_count", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "entities",
            T.StructType(
                [
                    T.StructField(
                        "hashtags",
                        T.ArrayType(T.StructType([T.StructField("tag", T.StringType())])),
                    )
                ]
            ),
        ),
    ]
)

ENVELOPE = T.StructType([T.StructField("data", T.ArrayType(POST))])

TWEETS = T.StructType(
    [
        T.StructField("tweet_id", T.LongType()),
        T.StructField("conversation_id", T.LongType()),
        T.StructField("author_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("retweet_count", T.IntegerType()),
        T.StructField("reply_count", T.IntegerType()),
        T.StructField("like_count", T.IntegerType()),
        T.StructField("quote_count", T.IntegerType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("batch_name", T.StringType()),
    ]
)

HASHTAGS = T.StructType(
    [
        T.StructField("tweet_id", T.LongType()),
        T.StructField("hashtag", T.StringType()),
    ]
)

WORD_PAIRS = T.StructType(
    [
        T.StructField("window_size", T.IntegerType()),
        T.StructField("word1", T.StringType()),
        T.StructField("word2", T.StringType()),
        T.StructField("word_count", T.LongType()),
    ]
)

# Counted literally: word_count * 2^doublings.
LITERAL_PAIRS = T.StructType(
    [
        T.StructField("window_size", T.IntegerType()),
        T.StructField("word1", T.StringType()),
        T.StructField("word2", T.StringType()),
        T.StructField("doublings", T.IntegerType()),
        T.StructField("word_count", T.LongType()),
    ]
)

BATCHES = T.StructType(
    [
        T.StructField("batch_name", T.StringType()),
        T.StructField("batch_status", T.StringType()),
    ]
)

# Batches as ingest writes them; a batch's rows are those of its last load.
LOADED = T.StructType([*BATCHES.fields, T.StructField("load", T.LongType())])

# Changes of status of stored batches, appended; the largest seq of a (batch, load) holds.
STATUS_LOG = T.StructType(
    [
        T.StructField("batch_name", T.StringType()),
        T.StructField("load", T.LongType()),
        T.StructField("batch_status", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)

COOCCURRENCE = T.StructType(
    [
        T.StructField("hashtag1", T.StringType()),
        T.StructField("hashtag2", T.StringType()),
        T.StructField("weight", T.LongType()),
    ]
)

LEXICON = T.StructType(
    [
        T.StructField("form", T.StringType()),
        T.StructField("lemma", T.StringType()),
    ]
)

TABLES = {
    "tweets": TWEETS,
    "hashtags": HASHTAGS,
    "wordpairs": WORD_PAIRS,
    "batches": BATCHES,
    "cooccurrence_network": COOCCURRENCE,
}

# Fixed values.
STATUSES = ("NEW", "PROCESSING", "SUCCESS", "FAILED")
RELEASED = "NONE"  # batch name of posts whose batch is done
ALL_BATCHES = "None"  # argument that selects every batch
HASHTAG_LENGTH = 255
EDGE_LAYER = "HT"
MIN_WINDOW = 2
MAX_WINDOW = 10
MAX_BATCH_BYTES = 20 * 1024
