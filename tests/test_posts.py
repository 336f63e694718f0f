"""Reading files, flattening, checks and the written tables."""

import json
import os

import pytest
from pyspark.sql import functions as F

import tagloom as tl
from tagloom.schemas import TWEETS
from tagloom.sources.tables import fresh_dir, shared_dir


def tag(*names):
    return {"hashtags": [{"tag": n} for n in names]}


POSTS_A = [
    {"id": "1", "author_id": "5000000000", "text": "hej", "entities": tag("Sol", "Sol"),
     "public_metrics": {"retweet_count": 3, "like_count": "4", "quote_count": None},
     "created_at": "2022-01-01T10:00:00.000+02:00", "more": [1, 2]},
    {"id": 2, "author_id": 7, "conversation_id": "9", "entities": {"hashtags": []}},
    {"id": "3", "author_id": "7", "public_metrics": None, "created_at": "2022-05-01T00:00:00Z",
     "entities": {"hashtags": [{"x": 1}, {"tag": None}, {"tag": "ok", "start": 3}]}},
    {"id": "2", "author_id": "8", "text": "again", "entities": tag("again")},
]
POSTS_B = [
    {"id": "1", "author_id": "1", "text": "later file"},
    {"id": "4", "text": "no author", "entities": tag("lost")},
    {"id": "x5", "author_id": "1", "entities": tag("lost")},
    {"author_id": "1"},
    {"id": "6", "author_id": "1", "entities": tag("h" * 256, "h" * 255)},
    {"id": "7", "author_id": "1", "created_at": "yesterday"},
]


@pytest.fixture
def folder(tmp_path):
    def write(batch, name, content):
        (tmp_path / batch).mkdir(parents=True, exist_ok=True)
        text = content if isinstance(content, str) else json.dumps(content, indent=1)
        (tmp_path / batch / name).write_text(text, encoding="utf-8")

    write("svt 1+å%", "a.json", {"data": POSTS_A, "meta": {"count": 4}})
    write("svt2/inner", "b.json", {"data": POSTS_B})
    write("svt2", "none.json", {"meta": {}})
    write("svt2", "other.txt", "not json")
    write("svt2", "empty.json", {"data": []})
    return tmp_path


def test_read(spark, folder, rows):
    raw = tl.read_tweets(spark, str(folder))
    found = raw.groupBy("batch_name").agg(F.count("*"), F.min("pos"), F.max("pos"))
    assert rows(found) == [("inner", 6, 0, 5), ("svt 1+å%", 4, 0, 3)]


def test_broken_file(spark, folder, rows):
    (folder / "svt2" / "broken.json").write_text('{"data": [{"id": ')
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED_RECORD"):
        tl.read_tweets(spark, str(folder)).collect()
    assert tl.read_tweets(spark, str(folder), fail_fast=False).count() == 10
    broken = rows(tl.broken_files(spark, str(folder)))
    assert [(f.rsplit("/", 1)[1], b, n) for f, b, n in broken] == [("broken.json", "svt2", 0)]


def test_unpack(spark, folder):
    tweets = tl.unpack_tweets(tl.read_tweets(spark, str(folder))).where("batch_name like 'svt%'")
    assert tweets.select(TWEETS.fieldNames()).schema.simpleString() == TWEETS.simpleString()
    one, two, three, _ = tweets.orderBy("pos").collect()
    assert (one.tweet_id, one.author_id, one.conversation_id) == (1, 5000000000, None)
    counters = ("retweet_count", "reply_count", "like_count", "quote_count")
    assert [one[c] for c in counters] == [3, 0, 4, 0]
    assert str(one.created_at) == "2022-01-01 10:00:00"
    assert (two.tweet_id, two.conversation_id, two.text, two.created_at) == (2, 9, None, None)
    assert [three[c] for c in counters] == [0, 0, 0, 0]


def test_unpack_hashtags(spark, folder, rows):
    tags = tl.unpack_hashtags(tl.read_tweets(spark, str(folder)))
    found = rows(tags.select("tweet_id", F.substring("hashtag", 1, 5)))
    assert found == [
        (1, "Sol"), (1, "Sol"), (2, "again"), (3, "ok"), (4, "lost"), (6, "hhhhh"), (6, "hhhhh"),
        (None, "lost"),
    ]


REJECTED = [
    (1, "later file", ["tweet_id repeated"]),
    (2, "again", ["tweet_id repeated"]),
    (4, "no author", ["author_id missing"]),
    (7, None, ["created_at does not fit"]),
    (None, None, ["tweet_id does not fit"]),
    (None, None, ["tweet_id missing"]),
]


@pytest.mark.parametrize("sized", [False, True])
def test_split(spark, folder, rows, sized):
    parts = tl.split_ingest(tl.read_tweets(spark, str(folder)), sized=sized)
    assert rows(parts.tweets.select("tweet_id")) == [(1,), (2,), (3,), (6,)]
    assert rows(parts.rejected_tweets.select("tweet_id", "text", "reasons")) == REJECTED
    kept = parts.hashtags.select("tweet_id", F.char_length("hashtag"))
    assert rows(kept) == [(1, 3), (1, 3), (3, 2), (6, 255)]
    bad = parts.rejected_hashtags.select("tweet_id", F.substring("hashtag", 1, 5), "reasons")
    assert rows(bad) == [
        (2, "again", ["post not stored"]),
        (4, "lost", ["post not stored"]),
        (6, "hhhhh", ["hashtag does not fit"]),
        (None, "lost", ["tweet_id missing"]),
    ]
    assert tl.orphan_hashtags(parts.hashtags, parts.tweets).count() == 0


def test_stored_posts_reject_new_ones(spark, folder, rows):
    stored = spark.createDataFrame([(1,), (6,), (99,)], "tweet_id long")
    raw = tl.read_tweets(spark, str(folder))
    assert rows(tl.split_ingest(raw, stored).tweets.select("tweet_id")) == [(2,), (3,)]
    assert rows(tl.split_ingest(raw, stored, sized=True).tweets.select("tweet_id")) == [(2,), (3,)]


def test_bad_row_does_not_take_the_id(spark, tmp_path, rows):
    (tmp_path / "b").mkdir()
    posts = [
        {"id": "1", "entities": tag("lost")},
        {"id": "1", "author_id": "2", "entities": tag("kept")},
        {"id": "1", "author_id": "3", "entities": tag("late")},
    ]
    (tmp_path / "b" / "a.json").write_text(json.dumps({"data": posts}))
    parts = tl.split_ingest(tl.read_tweets(spark, str(tmp_path)))
    assert rows(parts.tweets.select("tweet_id", "author_id")) == [(1, 2)]
    assert rows(parts.hashtags.select("hashtag")) == [("kept",)]
    reasons = parts.rejected_tweets.orderBy("pos").select("reasons").collect()
    assert [r[0] for r in reasons] == [["author_id missing"], ["tweet_id repeated"]]


def test_write_twice(spark, folder, rows, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    raw = tl.read_tweets(spark, str(folder))

    def tables():
        return [
            rows(tl.read_ingested(spark, out, t).drop("file"))
            for t in ("batches", "tweets", "hashtags", "rejected_tweets", "rejected_hashtags")
        ]

    tl.write_ingest(raw, out)
    first = tables()
    assert [len(t) for t in first[:2]] == [2, 4]
    tl.write_ingest(raw, out)
    assert tables() == first
    tl.write_ingest(raw, out, stored=tl.read_ingested(spark, out, "tweets"))
    assert tables() == first
    # A later batch with ids that are stored adds nothing and keeps the others.
    later = folder.parent / "later"
    (later / "svt9").mkdir(parents=True)
    (later / "svt9" / "c.json").write_text(
        json.dumps({"data": [{"id": "3", "author_id": "1"}, {"id": "8", "author_id": "1"}]})
    )
    tl.write_ingest(tl.read_tweets(spark, str(later)), out)
    ids = tl.read_ingested(spark, out, "tweets").select("tweet_id", "batch_name")
    assert rows(ids.where("batch_name = 'svt9'")) == [(8, "svt9")]
    assert ids.count() == 5


def test_batch_without_rows_is_emptied(spark, tmp_path, rows):
    out, batch = str(tmp_path / "out"), tmp_path / "in" / "svt 1+å%"
    batch.mkdir(parents=True)
    posts = [
        {"id": "1", "author_id": "1", "entities": tag("sol")},
        {"id": "2"},
    ]
    (batch / "a.json").write_text(json.dumps({"data": posts}))
    (tmp_path / "in" / "other").mkdir()
    (tmp_path / "in" / "other" / "b.json").write_text(
        json.dumps({"data": [{"id": "9", "author_id": "1", "entities": tag("bad")}, {"id": "8"}]})
    )
    tl.write_ingest(tl.read_tweets(spark, str(tmp_path / "in")), out)
    (batch / "a.json").write_text(json.dumps({"data": [{"id": "1", "author_id": "1"}]}))
    tl.write_ingest(tl.read_tweets(spark, str(batch)), out)
    found = rows(tl.read_ingested(spark, out, "tweets").select("tweet_id", "batch_name"))
    assert found == [(1, "svt 1+å%"), (9, "other")]
    assert rows(tl.read_ingested(spark, out, "hashtags").select("hashtag")) == [("bad",)]
    assert rows(tl.read_ingested(spark, out, "rejected_tweets").select("raw_tweet_id")) == [("8",)]


def test_a_failed_load_is_not_seen(spark, folder, rows, tmp_path_factory, monkeypatch):
    out = str(tmp_path_factory.mktemp("out"))
    raw = tl.read_tweets(spark, str(folder))
    tl.write_ingest(raw.where("batch_name = 'inner'"), out)
    before = rows(tl.read_ingested(spark, out, "tweets"))
    staging = shared_dir(spark)
    left = set(os.listdir(staging))
    spark.createDataFrame([(1,)], "tweet_id long").write.parquet(f"{out}/tweets/load=1")  # of a load that broke off
    assert rows(tl.read_ingested(spark, out, "tweets")) == before
    tl.write_ingest(raw, out)
    assert len(rows(tl.read_ingested(spark, out, "tweets"))) == 4
    assert not [d for d in set(os.listdir(staging)) - left if d.startswith("ingest-")]


def test_duplicates_of_one_hot_id(spark, rows):
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id + 10 END AS tweet_id", "'f' AS file", "id AS pos"
    )
    kept, rejected = tl.split_duplicates(df)
    assert kept.count() == 2001 and rejected.count() == 999
    assert rows(kept.where("tweet_id = 1").select("pos")) == [(0,)]


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured
    assert fresh_dir(spark, "x").startswith(f"{configured}/x-")
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://https://host"])
def test_a_cluster_must_name_its_shared_folder(master):
    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    Session.sparkContext.master = master
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_tables(spark, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS posts")
    tl.reset_tables(spark, "posts")
    assert tl.table_exists(spark, "posts.wordpairs") and not tl.table_exists(spark, "posts.none")
    assert spark.table("posts.tweets").schema == TWEETS
    row = spark.createDataFrame([("b", "NEW")], "batch_name string, batch_status string")
    row.write.insertInto("posts.batches")
    assert rows(tl.new_batches(spark.table("posts.batches"))) == [("b",)]
    tl.reset_tables(spark, "posts")
    assert spark.table("posts.batches").count() == 0
