import random
import re

import numpy as np
from pyspark.sql import functions as F

from tagloom.llm import near_dedup
from tagloom.llm.components import components
from tagloom.llm.near_dedup import drop_near_duplicates, near_duplicates, shingles, sketch


def shingle_set(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3)))


def expected(rows):
    """doc_id, n_shingles, component_id, kept of each row, by comparing all pairs."""
    sets = [shingle_set(text) for _, text, *_ in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = len(a & b)
            if a and b and 100 * both >= 80 * (len(a) + len(b) - both):
                label[find(i)] = find(j)
    out = []
    for i, (doc, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = min(ids, default=None) if sets[i] else doc
        out.append((doc, len(sets[i]), least, doc == least))
    return sorted(out, key=repr)


def compared(found):
    return sorted(map(tuple, found.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def test_edge_rows(edge, edge_rows):
    assert compared(near_duplicates(edge)) == expected(edge_rows)


def test_empty(empty):
    assert near_duplicates(empty).count() == 0


def _chains(seed, groups, length, words=60):
    """Texts that drift away from each other word by word, so that groups are chains."""
    rng = random.Random(seed)
    rows, doc = [], 0
    for g in range(groups):
        text = [f"g{g}w{rng.randrange(10**6)}" for _ in range(words)]
        for _ in range(length):
            rows.append((doc, " ".join(text)))
            doc += 1
            for _ in range(rng.choice((1, 2, 4))):
                text[rng.randrange(words)] = f"c{rng.randrange(10**6)}"
    rng.shuffle(rows)
    return rows


def test_chains(spark):
    rows = _chains(3, 6, 12)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert compared(near_duplicates(docs)) == expected(rows)


def test_rounds_of_pivots(spark, monkeypatch):
    """With no pairs left over allowed, more and more pivots find the same."""
    monkeypatch.setattr(near_dedup, "LEFT_OVER", 0)
    rows = _chains(4, 2, 30, words=40)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert compared(near_duplicates(docs)) == expected(rows)


def test_sketch_estimates():
    """Shares of equal coordinates are near the similarity, for small sets and large ones."""
    rng = np.random.default_rng(5)
    for size in (6, 20, 40, 3000):
        shares = []
        for _ in range(60 if size < 1000 else 6):
            a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
            b = np.unique(np.concatenate((a[: size * 9 // 10], rng.integers(0, 2**63, size // 10, dtype=np.uint64))))
            similarity = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            shares.append(np.mean(sketch(a) == sketch(b)) - similarity)
        assert abs(np.mean(shares)) < 0.03
        assert not (sketch(a) == np.uint64(2**64 - 1)).any()


def test_sketch_does_not_depend_on_the_way():
    found = np.unique(np.random.default_rng(1).integers(0, 2**63, 24, dtype=np.uint64))
    small = sketch(found)
    old, near_dedup._SMALL = near_dedup._SMALL, 0
    try:
        assert (sketch(found) == small).all()
    finally:
        near_dedup._SMALL = old


def test_shingles():
    assert len(shingles("A b C d e")) == 2
    assert (shingles("a B\tc\nd") == shingles("A b c d")).all()
    assert len(shingles("one two")) == 1
    assert not len(shingles(" \t")) and not len(shingles(None))


def test_parities_bound_the_difference():
    rng = np.random.default_rng(8)
    for size, new in ((50, 0), (50, 7), (600, 40), (5000, 900)):
        a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        b = np.unique(np.concatenate((a[new:], rng.integers(0, 2**63, new, dtype=np.uint64))))
        xor = near_dedup.parities(a) ^ near_dedup.parities(b)
        bits = sum(int(x).bit_count() for x in xor.view(np.uint64))
        different = len(np.setxor1d(a, b))
        assert bits <= different and (bits >= 0.7 * different or different > 100) and (new or not bits)


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 9), (9, 8), (8, 7), (7, 6), (6, 5), (20, 20), (30, 31), (31, 30)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == [(1, 1), (2, 1), (3, 1)] + [(i, 5) for i in range(5, 11)] + [
        (30, 30),
        (31, 30),
    ]


def test_hot_group_of_near_copies(spark):
    base = [f"w{i}" for i in range(100)]
    docs = spark.range(0, 600, 1, 6).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit(" ".join(base)), F.lit(" n"), F.col("id").cast("string")).alias("text"),
    )
    found = near_duplicates(docs)
    assert found.where("component_id = 0").count() == 600
    assert [r.doc_id for r in drop_near_duplicates(docs).collect()] == [0]


def test_dropping_keeps_columns(edge, edge_rows):
    kept = drop_near_duplicates(edge)
    assert kept.schema.names == edge.schema.names
    found = [r.doc_id for r in kept.collect()]
    stay = {repr((d, n)) for d, n, _, k in expected(edge_rows) if k}
    assert len(found) == len(stay)
    assert 8 not in found and found.count(3) == 1
