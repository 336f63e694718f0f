import zlib
from collections import defaultdict

from tagloom.llm.sharding import descend, hash_tree, shard_documents


def test_edge_rows(edge, edge_rows):
    found = shard_documents(edge).collect()
    want = sorted(((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in edge_rows), key=repr)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in found), key=repr) == want
    slots = defaultdict(list)
    for r in found:
        assert r.law == "key" and 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({(r.doc_id, r.shard) for r in found}) == len({r.doc_id for r in found})


def test_shares_and_growth(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    before = {r.doc_id: r.shard for r in descend(ids, hash_tree(8)).collect()}
    after = {r.doc_id: r.shard for r in descend(ids, hash_tree(9)).collect()}
    assert all(2300 < list(before.values()).count(s) < 2700 for s in range(8))
    moved = [after[d] for d in before if after[d] != before[d]]
    assert set(moved) == {8} and 2000 < len(moved) < 2450


def test_weights_change_in_a_subtree(spark):
    """A rack that gains weight takes documents from others; elsewhere nothing moves."""
    ids = spark.range(5_000).withColumnRenamed("id", "doc_id")
    tree = hash_tree(8)
    before = {r.doc_id: r for r in descend(ids, tree).collect()}
    tree["r0"]["k1"][3] = 3.0
    after = {r.doc_id: r for r in descend(ids, tree).collect()}
    for doc, was in before.items():
        now = after[doc]
        if was.region != now.region:
            assert (was.region, now.region) == ("r1", "r0")
        elif was.rack != now.rack:
            assert (was.rack, now.rack) == ("k0", "k1")
        elif was.shard != now.shard:
            assert (was.shard, now.shard) == (2, 3)


def test_no_weight(spark):
    ids = spark.range(100).withColumnRenamed("id", "doc_id")
    tree = hash_tree(8)
    tree["r1"] = {"k2": {4: 0.0, 5: 0.0}, "k3": {6: 0.0, 7: 1.0}}
    assert {r.shard for r in descend(ids, tree).collect()} <= {0, 1, 2, 3, 7}


def test_empty(empty):
    assert shard_documents(empty).count() == 0
