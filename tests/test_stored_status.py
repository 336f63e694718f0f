"""Status and release of batches in stored tables, and the id filter of later loads."""

import json
import re

import pytest
from pyspark.sql import functions as F

import tagloom as tl


def write(folder, batch, ids):
    (folder / batch).mkdir(parents=True, exist_ok=True)
    posts = [{"id": str(i), "author_id": "1", "text": f"post {i}"} for i in ids]
    (folder / batch / "a.json").write_text(json.dumps({"data": posts}))
    return str(folder / batch)


def test_status_log_and_release(spark, tmp_path, rows):
    out, posts = str(tmp_path / "out"), tmp_path / "in"
    write(posts, "b1", [1, 2, 3])
    write(posts, "b2", [10, 11])
    tl.write_ingest(tl.read_tweets(spark, str(posts)), out)
    assert rows(tl.read_ingested(spark, out, "batches")) == [("b1", "NEW"), ("b2", "NEW")]
    assert tl.set_stored_status(spark, out, "b1", "PROCESSING")
    assert not tl.set_stored_status(spark, out, "unknown", "FAILED")  # changes nothing
    with pytest.raises(ValueError):
        tl.set_stored_status(spark, out, "b1", "DONE")
    assert rows(tl.read_ingested(spark, out, "batches")) == [("b1", "PROCESSING"), ("b2", "NEW")]
    assert tl.release_stored_batch(spark, out, "b1")
    tl.set_stored_status(spark, out, "b1", "FAILED")  # released posts stay released
    assert rows(tl.read_ingested(spark, out, "batches")) == [("b1", "FAILED"), ("b2", "NEW")]
    tweets = tl.read_ingested(spark, out, "tweets").select("tweet_id", "batch_name")
    assert rows(tweets) == sorted([(1, "NONE"), (2, "NONE"), (3, "NONE"), (10, "b2"), (11, "b2")], key=repr)
    hashtags_read = tl.read_ingested(spark, out, "hashtags")
    assert "batch_name" in hashtags_read.columns

    # b1 comes again with an old id and a new one; b2 again replaces its unreleased load.
    write(tmp_path / "again", "b1", [3, 4])
    write(tmp_path / "again", "b2", [11, 12])
    tl.write_ingest(tl.read_tweets(spark, str(tmp_path / "again")), out)
    tweets = tl.read_ingested(spark, out, "tweets").select("tweet_id", "batch_name")
    assert rows(tweets) == sorted([(1, "NONE"), (2, "NONE"), (3, "NONE"), (4, "b1"), (11, "b2"), (12, "b2")], key=repr)
    assert rows(tl.read_ingested(spark, out, "rejected_tweets").select("raw_tweet_id")) == [("3",)]
    assert rows(tl.read_ingested(spark, out, "batches")) == [("b1", "NEW"), ("b2", "NEW")]
    assert rows(tl.new_batches(tl.read_ingested(spark, out, "batches"))) == [("b1",), ("b2",)]
    states = tl.batch_states(spark, out).select("batch_name", "load", "released", "live")
    assert rows(states) == [("b1", 0, True, False), ("b1", 1, False, True), ("b2", 0, False, False), ("b2", 1, False, True)]


def test_later_loads_read_only_the_range_of_their_ids(spark, tmp_path, rows):
    out, posts = str(tmp_path / "out"), tmp_path / "in"
    write(posts, "old", range(1, 400))
    tl.write_ingest(tl.read_tweets(spark, str(posts)), out)
    batches = spark.createDataFrame([("new",)], "batch_name string")
    ids = tl.stored_ids(spark, out, batches, 390, 500)
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(tweet_id,390)" in plan and "LessThanOrEqual(tweet_id,500)" in plan
    assert sorted(r.tweet_id for r in ids.collect()) == list(range(390, 400))
    assert tl.stored_ids(spark, out, batches, None, None).count() == 0
    # The stored posts are kept in sorted ranges of ids: each file holds one stretch.
    files = spark.read.parquet(f"{out}/tweets").selectExpr("input_file_name() AS f", "tweet_id")
    stretches = sorted(tuple(r)[1:] for r in files.groupBy("f").agg(F.min("tweet_id"), F.max("tweet_id")).collect())
    assert all(a[1] < b[0] for a, b in zip(stretches, stretches[1:]))
    write(tmp_path / "more", "new", [399, 450])
    tl.write_ingest(tl.read_tweets(spark, str(tmp_path / "more")), out)
    found = tl.read_ingested(spark, out, "tweets").where("batch_name = 'new'").select("tweet_id")
    assert rows(found) == [(450,)]


def test_one_batch_reads_its_own_load(spark, tmp_path, rows):
    out, posts = str(tmp_path / "out"), tmp_path / "in"
    write(posts, "b1", [1, 2])
    write(posts, "b2", [10, 11])
    tl.write_ingest(tl.read_tweets(spark, str(posts)), out)
    write(tmp_path / "later", "b2", [12])
    tl.write_ingest(tl.read_tweets(spark, str(tmp_path / "later")), out)
    tl.release_stored_batch(spark, out, "b1")
    for name, load, expected in (("b2", 1, [(12, "b2")]), ("NONE", 0, [(1, "NONE"), (2, "NONE")])):
        found = tl.read_ingested(spark, out, "tweets", batch=name)
        plan = found._jdf.queryExecution().executedPlan().toString()
        scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
        assert any(re.search(rf"load#\d+L? IN \({load}\)|\(load#\d+L? = {load}\)", s) for s in scans), scans
        assert rows(found.select("tweet_id", "batch_name")) == expected
    assert rows(tl.read_ingested(spark, out, "batches", batch="b2")) == [("b2", "NEW")]
    assert tl.read_ingested(spark, out, "tweets", batch="unknown").count() == 0
