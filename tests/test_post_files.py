import json

from pyspark.sql import functions as F

from tagloom.streaming.jobs import large_state
from workload import inputs


def test_files_are_full_whatever_the_number_of_batches(spark):
    post = F.to_json(F.struct(F.col("id").cast("string").alias("id")))
    posts = spark.range(0, 100, 1, 2).select(
        F.col("id").alias("tweet_id"), F.concat(F.lit("b"), F.col("id") % 5).alias("batch_name"), post.alias("json")
    )
    files = spark.read.text(inputs.post_files(posts, 10)).collect()
    ids = [[p["id"] for p in json.loads(r.value)["data"]] for r in files]
    assert sorted(map(len, ids)) == [10] * 10 and sorted(int(i) for f in ids for i in f) == list(range(100))


def test_large_state_leaves_the_session_as_it_was(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    with large_state(spark):
        assert "RocksDB" in spark.conf.get(name)
    assert spark.conf.get(name) == before
