import random
from collections import Counter
from itertools import combinations

import tagloom as tl

TAGS = [
    (1, "Sol"), (1, "sol"), (1, "Bad"), (2, "bad"), (2, "SOL"), (2, "Åre"),
    (3, "sol"), (3, "SOL"), (4, "x"),
]
EDGES = [("bad", "sol", 2), ("bad", "åre", 1), ("sol", "åre", 1)]


def tags(spark, pairs=TAGS):
    return spark.createDataFrame(pairs, "tweet_id long, hashtag string")


def test_goldens(spark, rows):
    assert rows(tl.cooccurrence(tags(spark))) == EDGES
    assert rows(tl.hashtag_sets(tags(spark))) == [(1, ["bad", "sol"]), (2, ["bad", "sol", "åre"])]
    assert rows(tl.set_pairs(tl.hashtag_sets(tags(spark)))) == rows(tl.hashtag_pairs(tags(spark)))
    assert {r[0] for r in rows(tl.multi_hashtag(tags(spark)))} == {1, 2, 3}


def test_merge_onto_itself(spark, rows):
    edges = tl.cooccurrence(tags(spark))
    twice = tl.merge_add(edges, edges, ("hashtag1", "hashtag2"), "weight")
    assert rows(twice) == [(a, b, 2 * w) for a, b, w in EDGES]


def test_one_post_with_many_hashtags(spark, rows):
    """A third of all rows belongs to one post; the result stays whole."""
    rnd = random.Random(5)
    pairs = [(0, f"T{rnd.randint(0, 60)}") for _ in range(400)]
    pairs += [(rnd.randint(1, 200), f"t{rnd.randint(0, 60)}") for _ in range(800)]
    expected = Counter()
    for post in {p for p, _ in pairs}:
        found = sorted({t.lower() for p, t in pairs if p == post})
        expected.update(combinations(found, 2))
    assert rows(tl.cooccurrence(tags(spark, pairs))) == sorted(
        ((a, b, n) for (a, b), n in expected.items()), key=repr
    )


def test_fetch(spark, rows):
    posts = spark.createDataFrame(
        [(1, 7, "2022-01-01 10:00:00", "x"), (2, 8, "2022-01-02 10:00:00", "y")],
        "tweet_id long, author_id long, created_at string, batch_name string",
    ).selectExpr("tweet_id", "author_id", "CAST(created_at AS timestamp_ntz) AS created_at", "batch_name")

    def ids(**filters):
        return {r[0] for r in rows(tl.fetch_hashtags(tags(spark), posts, **filters))}

    assert ids() == {1, 2}
    assert ids(batch="x") == {1}
    assert ids(batch="", from_date=None) == {1, 2}
    assert ids(from_date="2022-01-02 10:00:00") == {2}
    assert ids(to_date="2022-01-01 10:00:00") == {1}
    assert ids(batch="x", from_date="2022-01-02") == set()
    found = tl.fetch_hashtags(tags(spark), posts)
    assert found.columns == ["tweet_id", "hashtag", "author_id", "created_at", "batch_name"]
    assert found.count() == 6


def test_rebuild(spark, rows, tmp_path):
    posts = spark.createDataFrame(
        [(1, 1, "x"), (2, 1, "x"), (3, 1, "x")], "tweet_id long, author_id long, batch_name string"
    ).selectExpr("*", "TIMESTAMP_NTZ'2022-01-01' AS created_at")
    for _ in range(2):
        tl.rebuild_network(tags(spark), posts, str(tmp_path / "net"))
        assert rows(tl.read_cooccurrence(spark, str(tmp_path / "net"))) == EDGES
    assert rows(tl.hashtag_network(tags(spark), posts, batch="y")) == []


def test_network(spark, rows):
    edges = tl.network_edges(tl.cooccurrence(tags(spark)))
    assert rows(edges)[0] == ("bad", "HT", "sol", "HT", 2)
    assert rows(tl.network_vertices(edges)) == [("bad", "HT"), ("sol", "HT"), ("åre", "HT")]
