"""One query per operator; each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tagloom as tl
from tagloom.operators.merge import EDGE_KEYS, PAIR_KEYS
from tagloom.sources.tables import fresh_dir
from tagloom.streaming.jobs import large_state
from workload import inputs as i

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


# --- text -------------------------------------------------------------------


@query
def clean_documents(spark, sf):
    return i.table(spark, sf, "documents").select("doc_id", tl.clean_text("text").alias("cleaned"))


@query
def clean_page_urls(spark, sf):
    return i.table(spark, sf, "pages").select(
        "page_id",
        tl.clean_text("url").alias("cleaned"),
        tl.clean_text("url", remove_urls=False).alias("with_urls"),
        tl.clean_text("url", remove_urls=False, remove_special_chars=False).alias("with_special"),
        tl.clean_text(
            "url", remove_urls=False, remove_special_chars=False, remove_digits=False
        ).alias("with_digits"),
    )


@query
def token_counts(spark, sf):
    return i.table(spark, sf, "documents").select(
        "doc_id",
        F.size(tl.tokens("text")).alias("raw_tokens"),
        F.size(tl.words("text")).alias("clean_tokens"),
    )


@query
def document_lines(spark, sf):
    return tl.units(i.table(spark, sf, "documents"), ("doc_id",), unit="line")


@query
def lemmas(spark, sf):
    turns = i.conversations(spark, sf).select("tweet_id", "text")
    spoken = tl.lemmatise(tl.with_words(turns), i.lexicon(spark), keys=("tweet_id",))
    return spoken.select("tweet_id", F.array_join("words", " ").alias("lemmas"))


# --- word pairs -------------------------------------------------------------


@query
def endpoint_pairs(spark, sf):
    turns = tl.with_words(i.conversations(spark, sf).select("tweet_id", "text"))
    return tl.endpoint_pairs(turns, ("tweet_id",))


@query
def pairs_by_line(spark, sf):
    return tl.word_pairs(i.spread(i.documents(spark, sf)), unit="line")


@query
def pairs_by_record(spark, sf):
    return tl.word_pairs(i.spread(i.conversations(spark, sf)), batch="None", kmin=3, kmax=4)


@query
def pairs_literal(spark, sf):
    return tl.word_pairs(i.documents(spark, sf), unit="line", mode="literal")


@query
def pairs_literal_overflow(spark, sf):
    return tl.literal_overflow(tl.word_pairs(i.documents(spark, sf), unit="line", mode="literal"))


@query
def batch_pairs(spark, sf):
    return tl.word_pairs(i.conversations(spark, sf), batch="assistant")


@query
def lemmatised_pairs(spark, sf):
    return tl.word_pairs(i.conversations(spark, sf), lexicon=i.lexicon(spark))


# --- posts and checks -------------------------------------------------------


@query
def unpack_tweets(spark, sf):
    return tl.unpack_tweets(i.raw_posts(i.order_posts(spark, sf))).select(
        "tweet_id", "conversation_id", "author_id", "text", "retweet_count", "reply_count",
        "like_count", "quote_count", "created_at", "batch_name",
    )


@query
def unpack_hashtags(spark, sf):
    return tl.unpack_hashtags(i.raw_posts(i.order_posts(spark, sf))).select("tweet_id", "hashtag")


@query
def read_tweets(spark, sf):
    folder = i.post_files(i.order_posts(spark, sf), 5000)
    return tl.unpack_tweets(tl.read_tweets(spark, folder)).select(
        "tweet_id", "text", "like_count", "batch_name"
    )


@query
def bad_rows(spark, sf):
    checked = tl.check_tweets(tl.unpack_tweets(i.raw_posts(i.order_posts(spark, sf))))
    return tl.split_checked(checked)[1].select(
        "tweet_id", F.array_join("reasons", ";").alias("reasons")
    )


@query
def bad_hashtags(spark, sf):
    tags = i.table(spark, sf, "documents").select(
        F.col("doc_id").alias("tweet_id"), F.col("text").alias("hashtag")
    )
    return tl.split_checked(tl.check_hashtags(tags))[1].select(
        "tweet_id", F.array_join("reasons", ";").alias("reasons")
    )


@query
def bad_rows_every_rule(spark, sf):
    """Orders as posts that break each rule of V2 and V3 in turn, several at once on some."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    post = F.struct(
        F.when(key % 19 == 0, F.concat(F.lit("k"), key.cast("string"))).when(key % 17 != 0, key.cast("string")).alias("id"),
        F.when(key % 7 == 0, F.concat(F.lit("c"), customer)).otherwise(customer).alias("conversation_id"),
        F.when(key % 11 == 0, F.concat(F.lit("x"), customer)).when(key % 13 != 0, customer).alias("author_id"),
        key.cast("string").alias("text"),
        F.when(key % 5 == 0, F.lit("not a date")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("created_at"),
    )
    posts = i.table(spark, sf, "orders").select(
        key.alias("tweet_id"), F.lit("orders").alias("batch_name"), F.to_json(post).alias("json")
    )
    checked = tl.check_tweets(tl.unpack_tweets(i.raw_posts(posts)))
    return tl.split_checked(checked)[1].select(F.col("text").alias("key"), F.array_join("reasons", ";").alias("reasons"))


@query
def bad_hashtags_every_rule(spark, sf):
    """Documents as hashtags without post, without text, or too long."""
    docs = i.table(spark, sf, "documents")
    tags = docs.select(
        F.col("doc_id").alias("key"),
        F.when(F.col("doc_id") % 7 != 0, F.col("doc_id")).alias("tweet_id"),
        F.when(F.col("doc_id") % 3 != 0, F.col("text")).alias("hashtag"),
    )
    return tl.split_checked(tl.check_hashtags(tags))[1].select("key", F.array_join("reasons", ";").alias("reasons"))


_LINE = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")


@query
def dup_tweets(spark, sf):
    rows = i.table(spark, sf, "lineitem").select("l_orderkey", *_LINE)
    return tl.mark_duplicates(rows, key="l_orderkey", order=_LINE)


@query
def stored_dup_tweets(spark, sf):
    rows = i.table(spark, sf, "lineitem").select("l_orderkey", *_LINE)
    stored = (
        i.table(spark, sf, "orders")
        .where("o_orderstatus = 'F'")
        .select(F.col("o_orderkey").alias("l_orderkey"))
    )
    return tl.split_duplicates(rows, stored, key="l_orderkey", order=_LINE)[0]


@query
def orphans(spark, sf):
    posts = i.orders(spark, sf).where("batch_name <> '5-LOW'")
    return tl.orphan_hashtags(i.hashtags(spark, sf), posts)


@query
def ingest_tweets(spark, sf):
    folder = i.post_files(i.conversation_posts(spark, sf, repeats=True), 100)
    out = fresh_dir(spark, "ingest")
    tl.write_ingest(tl.read_tweets(spark, folder), out)
    return tl.read_ingested(spark, out, "tweets").select("tweet_id", "text")


@query
def ingest_hashtags(spark, sf):
    folder = i.post_files(i.order_posts(spark, sf), 5000)
    out = fresh_dir(spark, "ingest")
    tl.write_ingest(tl.read_tweets(spark, folder), out)
    return tl.read_ingested(spark, out, "hashtags").select("tweet_id", "hashtag", "batch_name")


def _ingested_twice(spark, sf):
    """Turns with an even id, then all of them as a second batch, then the first batch again."""
    out = fresh_dir(spark, "ingest")
    posts = i.conversation_posts(spark, sf, repeats=False)
    even = posts.where("tweet_id % 2 = 0").withColumn("batch_name", F.lit("first"))
    every = posts.withColumn("batch_name", F.lit("second"))
    for load in (even, every, even):
        tl.write_ingest(tl.read_tweets(spark, i.post_files(load, 500)), out)
    return out


@query
def ingest_twice(spark, sf):
    out = _ingested_twice(spark, sf)
    return tl.read_ingested(spark, out, "tweets").select("tweet_id", "text", "batch_name")


def _stored_cycle(spark, sf):
    """Even turns as batch ``first``, odd ones as ``second``, taken through their statuses in stored tables.

    Both are loaded and found NEW (S5); ``first`` is taken up, its word pairs are
    counted from the stored posts (P4) and written, and it succeeds, which gives
    its posts back (M5, M6); ``second`` is taken up and fails. Then ``first`` is
    loaded again: its posts were given back, so all of them are repeated ids.
    """
    out = fresh_dir(spark, "cycle")
    posts = i.conversation_posts(spark, sf, repeats=False)
    first = posts.where("tweet_id % 2 = 0").withColumn("batch_name", F.lit("first"))
    second = posts.where("tweet_id % 2 = 1").withColumn("batch_name", F.lit("second"))
    tl.write_ingest(tl.read_tweets(spark, i.post_files(first.unionByName(second), 500)), out)
    waiting = tl.new_batches(tl.read_ingested(spark, out, "batches"))
    for name in sorted(r.batch_name for r in waiting.collect()):  # a row per batch
        tl.set_stored_status(spark, out, name, "PROCESSING")
        if name.endswith("first"):
            stored = tl.read_ingested(spark, out, "tweets")
            tl.word_pairs(stored, batch=name).write.mode("overwrite").parquet(f"{out}/pairs/{name}")
            tl.set_stored_status(spark, out, name, "SUCCESS")
        else:
            tl.set_stored_status(spark, out, name, "FAILED")
    tl.write_ingest(tl.read_tweets(spark, i.post_files(first, 500)), out)
    return out


@query
def stored_batch_cycle(spark, sf):
    return tl.read_ingested(spark, _stored_cycle(spark, sf), "tweets").select("tweet_id", "text", "batch_name")


@query
def stored_batch_states(spark, sf):
    return tl.read_ingested(spark, _stored_cycle(spark, sf), "batches")


@query
def stored_cycle_pairs(spark, sf):
    return spark.read.parquet(f"{_stored_cycle(spark, sf)}/pairs/batch_name=first")


@query
def ingested_batch_text(spark, sf):
    """S3 over stored tables: the texts of one batch, read from its own load only."""
    out = _ingested_twice(spark, sf)
    return tl.batch_text(tl.read_ingested(spark, out, "tweets", batch="batch_name=first"), "batch_name=first")


@query
def ingested_batches(spark, sf):
    return tl.read_ingested(spark, _ingested_twice(spark, sf), "batches")


@query
def reset_and_fill(spark, sf):
    """Tables made, filled, emptied and filled again; which of three are there, and a row count."""
    folder = fresh_dir(spark, "filled")
    database = folder.rpartition("/")[2].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}'")
    edges = tl.cooccurrence(i.hashtags(spark, sf)).select("hashtag1", "hashtag2", "weight")
    for _ in range(2):
        tl.reset_tables(spark, database, ("cooccurrence_network", "batches"))
        edges.write.insertInto(f"{database}.cooccurrence_network")
    there = [tl.table_exists(spark, f"{database}.{t}") for t in ("cooccurrence_network", "batches", "tweets")]
    batches = spark.table(f"{database}.batches").count()
    return spark.table(f"{database}.cooccurrence_network").select(
        "*", F.lit("".join("01"[t] for t in there)).alias("there"), F.lit(batches).cast("long").alias("batches")
    )


# --- batches ----------------------------------------------------------------


@query
def next_fit_batches(spark, sf):
    items = i.table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    return tl.assign_batches(items, "source", "doc_id", "n_chars")


def _sources(spark, sf):
    return i.table(spark, sf, "documents").select(F.col("source").alias("batch_name")).distinct()


@query
def batches_of_folder(spark, sf):
    return tl.batches_of(_sources(spark, sf), "src")


@query
def max_batch_index(spark, sf):
    return tl.max_batch_index(_sources(spark, sf), "src")


@query
def register_batches(spark, sf):
    # Batch names with a status derived from their number; even ones come again.
    names = _sources(spark, sf)
    number = F.regexp_extract("batch_name", r"(\d+)$", 1).cast("int")
    old = names.where(number < 15).withColumn(
        "batch_status", F.when(number % 3 == 0, "SUCCESS").otherwise("FAILED")
    )
    return tl.upsert_batches(old, names.where(number % 2 == 0))


@query
def new_batches(spark, sf):
    return tl.new_batches(register_batches(spark, sf))


@query
def set_batch_status(spark, sf):
    batches = tl.set_status(register_batches(spark, sf), "src2", "PROCESSING")
    return tl.set_status(batches, "unknown", "FAILED")


@query
def release_batch(spark, sf):
    return tl.release_batch(i.documents(spark, sf).drop("text"), "src7")


@query
def batch_text(spark, sf):
    return tl.batch_text(i.conversations(spark, sf), "user")


# --- hashtags ---------------------------------------------------------------


@query
def hashtag_fetch(spark, sf):
    return tl.fetch_hashtags(
        i.hashtags(spark, sf), i.orders(spark, sf), "1-URGENT", "1996-01-01", "1998-12-31"
    )


@query
def hashtag_fetch_all(spark, sf):
    return tl.fetch_hashtags(i.hashtags(spark, sf), i.orders(spark, sf))


@query
def multi_hashtag_tweets(spark, sf):
    return tl.multi_hashtag(i.hashtags(spark, sf))


@query
def hashtag_sets(spark, sf):
    return tl.hashtag_sets(i.hashtags(spark, sf)).select(
        "tweet_id", F.array_join("hashtags", ",").alias("hashtags")
    )


@query
def set_pairs(spark, sf):
    return tl.set_pairs(tl.hashtag_sets(i.hashtags(spark, sf)))


@query
def hashtag_pairs(spark, sf):
    return tl.hashtag_pairs(i.hashtags(spark, sf))


@query
def cooccurrence(spark, sf):
    return tl.cooccurrence(i.hashtags(spark, sf))


@query
def hashtag_network(spark, sf):
    return tl.hashtag_network(
        i.hashtags(spark, sf), i.orders(spark, sf), from_date="1997-01-01", to_date="1999-12-31"
    )


@query
def network_edges(spark, sf):
    return tl.network_edges(cooccurrence(spark, sf))


@query
def network_vertices(spark, sf):
    return tl.network_vertices(network_edges(spark, sf))


@query
def stored_cooccurrence(spark, sf):
    path = fresh_dir(spark, "cooccurrence")
    cooccurrence(spark, sf).write.parquet(path)
    return tl.read_cooccurrence(spark, path)


# --- merges -----------------------------------------------------------------


@query
def merge_add_pairs(spark, sf):
    turns = i.conversations(spark, sf)
    old = tl.word_pairs(turns.where("tweet_id % 2 = 0"))
    new = tl.word_pairs(turns.where("tweet_id % 2 = 1"))
    return tl.merge_add(old, new, PAIR_KEYS, "word_count")


@query
def merge_add_edges(spark, sf):
    tags = i.hashtags(spark, sf)
    old = tl.cooccurrence(tags.where("tweet_id % 2 = 0"))
    new = tl.cooccurrence(tags.where("tweet_id % 2 = 1"))
    return tl.merge_add(old, new, EDGE_KEYS, "weight")


@query
def merge_add_one_edge(spark, sf):
    edge = spark.sql("SELECT 'brand#1' AS hashtag1, 'brand#2' AS hashtag2, 5L AS weight")
    return tl.merge_add(cooccurrence(spark, sf), edge, EDGE_KEYS, "weight")


@query
def stored_merge_pairs(spark, sf):
    """Word pairs of even turns stored by bucket, those of odd turns added to them."""
    turns = i.conversations(spark, sf)
    path = fresh_dir(spark, "pair-totals")
    for half in ("tweet_id % 2 = 0", "tweet_id % 2 = 1"):
        tl.merge_add_stored(spark, path, tl.word_pairs(turns.where(half)), PAIR_KEYS, "word_count")
    return tl.read_totals(spark, path)


@query
def stored_merge_edges(spark, sf):
    """Co-occurrence of even posts stored by bucket, that of odd posts added, then one edge."""
    tags = i.hashtags(spark, sf)
    path = fresh_dir(spark, "edge-totals")
    for half in ("tweet_id % 2 = 0", "tweet_id % 2 = 1"):
        tl.merge_add_stored(spark, path, tl.cooccurrence(tags.where(half)), EDGE_KEYS, "weight")
    edge = spark.sql("SELECT 'brand#1' AS hashtag1, 'brand#2' AS hashtag2, 5L AS weight")
    tl.merge_add_stored(spark, path, edge, EDGE_KEYS, "weight")
    return tl.read_totals(spark, path)


# --- streams ----------------------------------------------------------------


def _job(spark, posts, posts_per_file, max_files, run):
    folder = i.post_files(posts, posts_per_file)
    out = fresh_dir(spark, "job")
    run(spark, folder, out, f"{out}/checkpoint", max_files=max_files)
    return out


@query
def stream_pairs(spark, sf):
    posts = i.conversation_posts(spark, sf, repeats=True)
    out = _job(spark, posts, 100, 20, tl.run_word_pairs)
    return tl.pair_totals(spark, out)


@query
def stream_pairs_literal(spark, sf):
    out = _job(spark, i.document_posts(spark, sf), 200, 50, partial(tl.run_word_pairs, mode="literal"))
    return tl.pair_totals(spark, out, "literal")


@query
def stream_batch_status(spark, sf):
    posts = i.conversation_posts(spark, sf, repeats=False)
    out = _job(spark, posts, 200, 20, tl.run_word_pairs)
    return tl.batch_status(spark, out)


@query
def stream_cooccurrence(spark, sf):
    out = _job(spark, i.order_posts(spark, sf), 5000, 50, tl.run_cooccurrence)
    return tl.cooccurrence_totals(spark, out)


@query
def running_pairs(spark, sf):
    folder = i.post_files(i.conversation_posts(spark, sf, repeats=True), 100)
    out = fresh_dir(spark, "running")
    counts = tl.running_pairs(tl.stream_tweets(spark, folder, max_files=20))
    with large_state(spark):
        (
            counts.writeStream.outputMode("update")
            .foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{out}/load_id={n}"))
            .option("checkpointLocation", f"{out}-checkpoint")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    states = spark.read.parquet(out)
    return states.groupBy(*PAIR_KEYS).agg(F.max_by("word_count", "load_id").alias("word_count"))
