"""What bounds the memory of a task where the tables grow."""

import re

import tagloom as tl
from tagloom.operators.sizes import ADVISORY, SHUFFLE_BYTES, lean_shuffles
from workload import inputs


def test_the_network_joins_posts_once(spark):
    """The join with posts runs in stages of its own, whose rows both sides of the self-join read (F10)."""
    tags = spark.range(50).selectExpr("id % 25 AS tweet_id", "CAST(id % 7 AS string) AS hashtag")
    posts = spark.range(50).selectExpr(
        "id AS tweet_id", "1L AS author_id", "TIMESTAMP_NTZ'2022-01-01' AS created_at", "'b' AS batch_name"
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        execution = tl.hashtag_network(tags, posts)._jdf.queryExecution()
        execution.toRdd().count()
        plan = execution.executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"SortMergeJoin", plan)) == 2
    assert "ReusedExchange" in plan


def test_shuffled_rows_of_a_task(spark):
    before = spark.conf.get(ADVISORY)
    try:
        spark.conf.set(ADVISORY, "64MB")
        tl.cooccurrence(spark.sql("SELECT 1L AS tweet_id, 'a' AS hashtag"))
        assert spark.conf.get(ADVISORY) == str(SHUFFLE_BYTES)
        spark.conf.set(ADVISORY, "20KB")  # a setting of the session stays
        lean_shuffles(spark.range(1))
        assert spark.conf.get(ADVISORY) == "20KB"
    finally:
        spark.conf.set(ADVISORY, before)


def test_hashtags_of_a_load_need_no_join(spark, tmp_path):
    """Hashtags travel with their posts, and stored rows meet the loads in a broadcast (F11)."""
    posts = spark.range(200).selectExpr(
        "CAST(id % 150 AS string) AS id", "'a' AS author_id", "array(named_struct('tag', CAST(id AS string))) AS tags"
    )
    element = "named_struct('id', id, 'author_id', IF(id % 3 = 0, 'a', '7'), 'entities', named_struct('hashtags', tags))"
    for name in ("x", "y"):
        some = posts.where("id % 2 = 0" if name == "x" else "id % 2 = 1")
        some.selectExpr(f"collect_list({element}) AS data").write.json(str(tmp_path / "posts" / name))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        raw = tl.read_tweets(spark, str(tmp_path / "posts"))
        parts = tl.split_ingest(raw)
        joins = [str(t._jdf.queryExecution().executedPlan().toString()).count("Join") for t in (parts.tweets, parts.hashtags)]
        assert joins[0] == joins[1]
        tl.write_ingest(raw, str(tmp_path / "out"))
        stored = tl.read_ingested(spark, str(tmp_path / "out"), "hashtags")
        plan = stored._jdf.queryExecution().executedPlan().toString()
        found = sorted((r.tweet_id, r.hashtag) for r in stored.collect())
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    top = next(line for line in plan.splitlines() if "Join" in line)
    assert "BroadcastHashJoin [batch_name" in top
    # The first element with an id stays, with its own hashtag; authors of every third id do not fit.
    assert len(found) == 100 and all(int(tag) % 150 == i and i % 3 for i, tag in found)


def test_post_files_by_pieces(spark):
    """A batch of more rows than a piece holds is dealt to several tasks, with no post lost (F11)."""
    posts = spark.range(0, 450_000, 1, 1).selectExpr(
        "id AS tweet_id", "IF(id < 0, 'c', 'b') AS batch_name", "concat('{\"id\":\"', id, '\"}') AS json"
    )
    files = spark.read.text(inputs.post_files(posts, 5000))
    sizes = files.selectExpr("size(from_json(value, 'data array<struct<id string>>').data) AS n")
    assert sizes.agg({"n": "sum"}).first()[0] == 450_000
    assert {r.n for r in sizes.collect()} == {5000}
    ids = files.selectExpr("explode(from_json(value, 'data array<struct<id string>>').data.id) AS id")
    assert ids.distinct().count() == 450_000
    tasks = files.selectExpr("regexp_extract(_metadata.file_name, 'part-([0-9]+)', 1) AS task").distinct()
    assert tasks.count() > 1
