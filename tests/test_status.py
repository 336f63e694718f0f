import pytest

import tagloom as tl


def batches(spark, *pairs):
    return spark.createDataFrame(list(pairs), "batch_name string, batch_status string")


def test_register(spark, rows):
    old = batches(spark, ("b1", "SUCCESS"), ("b2", "FAILED"))
    names = spark.createDataFrame([("b1",), ("b3",), ("b3",)], "batch_name string")
    new = tl.upsert_batches(old, names)
    assert rows(new) == [("b1", "NEW"), ("b2", "FAILED"), ("b3", "NEW")]
    assert rows(tl.new_batches(new)) == [("b1",), ("b3",)]


def test_set_status(spark, rows):
    old = batches(spark, ("b1", "NEW"), ("b2", "NEW"))
    assert rows(tl.set_status(old, "b1", "SUCCESS")) == [("b1", "SUCCESS"), ("b2", "NEW")]
    assert rows(tl.set_status(old, "b9", "SUCCESS")) == rows(old)
    with pytest.raises(ValueError):
        tl.set_status(old, "b1", "DONE")


def test_release(spark, rows):
    tweets = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "tweet_id long, batch_name string")
    assert rows(tl.release_batch(tweets, "a")) == [(1, "NONE"), (2, "b"), (3, None)]


def test_merge_in_parts_equals_count_of_all(spark, rows):
    keys = ("window_size", "word1", "word2")
    texts = [(i, t) for i, t in enumerate(["a b c", "c b", "a a b", "b c a", "a b"])]
    df = spark.createDataFrame(texts, "tweet_id long, text string")
    merged = tl.word_pairs(df.where("tweet_id < 0"))
    for part in range(3):
        delta = tl.word_pairs(df.where(f"tweet_id % 3 = {part}"))
        merged = tl.merge_add(merged, delta, keys, "word_count")
    assert rows(merged) == rows(tl.word_pairs(df))
    assert merged.dtypes == tl.word_pairs(df).dtypes
