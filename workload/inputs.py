"""The given tables in the roles of the data model.

========== =====================================================
posts      ``orders`` (dates, keys), ``conversations`` (short
           texts), ``documents`` (long texts)
hashtags   ``lineitem`` with the brand of its ``part``
========== =====================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.operators.sizes import partitions
from tagloom.schemas import POST
from tagloom.sources.tables import fresh_dir

# Words of the test data's texts with made-up lemmas: changed, dropped (null or
# empty), of two words, and one form listed twice (the smaller lemma counts).
LEXICON = [
    ("the", None), ("a", ""), ("an", "a"), ("is", "be"), ("are", "be"), ("was", "be"),
    ("has", "have"), ("des", "de le"), ("du", "de le"), ("les", "le"), ("la", "le"),
    ("der", "die"), ("den", "die"), ("das", "die"), ("zum", "zu die"), ("thth", "th th"),
    ("er", "ich"), ("es", "ich"), ("he", "i"), ("it", "i"), ("it", "x"), ("en", None),
    ("tion", "tio"), ("ing", "in g"), ("of", "of"),
]


MASK = (1 << 33) - 1  # of a row's number in its partition
SPREAD_BYTES = 2 << 20  # so that the pairs of a piece fit the memory of a task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lexicon(spark: SparkSession) -> DataFrame:
    """As an inline table, whose size Spark knows when it plans the join."""
    rows = ", ".join(
        f"('{form}', {'NULL' if lemma is None else repr(lemma)})" for form, lemma in LEXICON
    )
    return spark.sql(f"SELECT form, lemma FROM VALUES {rows} AS lexicon(form, lemma)")


def spread(df: DataFrame) -> DataFrame:
    """Rows of a table dealt out to all cores, in pieces that do not grow with the table."""
    return df.repartition(partitions(df, SPREAD_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("tweet_id"), "text", F.col("source").alias("batch_name")
    )


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("tweet_id"),
        "text",
        F.col("role").alias("batch_name"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("tweet_id"),
        F.col("o_custkey").alias("author_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"),
        F.col("o_orderpriority").alias("batch_name"),
    )


def hashtags(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("tweet_id"), F.col("p_brand").alias("hashtag")
    )


def order_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as nested posts, with missing and misfit values here and there.

    tweet_id, batch_name, json; nulls are left out of the JSON.
    """
    key = F.col("o_orderkey")
    customer = F.col("o_custkey").cast("string")
    tags = F.array(
        "o_orderstatus",
        F.lower("o_orderstatus"),
        F.substring("o_orderpriority", 3, 20),
        F.concat(F.lit("Cust"), F.col("o_custkey") % 40),
        F.concat(F.lit("Month"), F.month("o_orderdate")),
    )
    some_tags = F.when(key % 9 == 0, F.slice(tags, 1, 0)).otherwise(tags)
    post = F.struct(
        key.cast("string").alias("id"),
        F.col("o_custkey").alias("conversation_id"),
        F.when(key % 13 == 0, F.concat(F.lit("x"), customer))
        .when(key % 11 != 0, customer)
        .alias("author_id"),
        F.concat_ws(" ", "o_orderstatus", "o_orderpriority").alias("text"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("created_at"),
        F.when(
            key % 5 != 0,
            F.struct(
                F.floor("o_totalprice").alias("retweet_count"),
                F.when(key % 2 != 0, F.lit("7")).alias("reply_count"),
                (key % 100).cast("string").alias("like_count"),
            ),
        ).alias("public_metrics"),
        F.when(
            key % 7 != 0,
            F.struct(F.transform(some_tags, lambda t: F.struct(t.alias("tag"))).alias("hashtags")),
        ).alias("entities"),
    )
    return table(spark, sf_dir, "orders").select(
        key.alias("tweet_id"),
        F.col("o_orderpriority").alias("batch_name"),
        F.to_json(post).alias("json"),
    )


def conversation_posts(spark: SparkSession, sf_dir: str, repeats: bool) -> DataFrame:
    """Conversations as nested posts; with ``repeats`` some come twice."""
    posts = conversations(spark, sf_dir)
    if repeats:
        again = posts.where(F.col("tweet_id") % 3 == 0).withColumn("batch_name", F.lit("again"))
        posts = posts.unionByName(again)
    post = F.struct(
        F.col("tweet_id").alias("id"), F.lit(1).alias("author_id"), F.col("text").alias("text")
    )
    return posts.select("tweet_id", "batch_name", F.to_json(post).alias("json"))


def document_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as nested posts: long texts, with words that come very often."""
    post = F.struct(F.col("tweet_id").alias("id"), F.lit(1).alias("author_id"), "text")
    return documents(spark, sf_dir).select("tweet_id", "batch_name", F.to_json(post).alias("json"))


def raw_posts(posts: DataFrame) -> DataFrame:
    """What ``read_tweets`` would give for these posts."""
    return posts.select(
        F.col("batch_name").alias("file"),
        "batch_name",
        (F.col("tweet_id") % 1000).cast("int").alias("pos"),
        F.from_json("json", POST).alias("post"),
    )


def post_files(posts: DataFrame, posts_per_file: int) -> str:
    """Write posts as JSON files, a folder per batch, and return their folder.

    A file is one object with posts of one batch: ``posts_per_file`` of those in a
    piece of the table (or the rest), so that no file grows with the size of a
    batch, and many batches do not make many small files. A piece is a partition's
    next 40 files of rows, 200,000 at least, and the posts are dealt to a partition
    per ``SPREAD_BYTES`` of the table, so that no task grows with the table.
    """
    folder = fresh_dir(posts.sparkSession, "posts")
    piece = ("part", "piece", "batch_name")
    in_batch = Window.partitionBy(*piece).orderBy("row")
    numbered = posts.withColumns({"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()})
    in_part = F.col("row").bitwiseAND(F.lit(MASK))
    numbered = numbered.withColumn("piece", F.floor(in_part / max(40 * posts_per_file, 200_000)))
    files = (
        numbered.repartition(partitions(posts, SPREAD_BYTES), *piece)
        .withColumn("stretch", F.floor((F.row_number().over(in_batch) - 1) / posts_per_file))
        .groupBy(*piece, "stretch")
        .agg(F.collect_list(F.from_json("json", POST)).alias("data"))
    )
    (
        files.select("batch_name", "data")
        .write.option("maxRecordsPerFile", 1)
        .partitionBy("batch_name")
        .json(folder)
    )
    return folder
