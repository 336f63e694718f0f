"""Literal counts without a row per pair, and partitions by the size of the input."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from test_pairs import fold, random_texts

import tagloom as tl
from tagloom.operators import literal
from tagloom.operators.sizes import partitions, stored_bytes
from workload import inputs


def test_no_sort_or_window_has_a_row_per_pair(spark):
    df = tl.word_pairs(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr(
        "doc_id AS tweet_id", "text", "source AS batch_name"), unit="line", mode="literal")
    df._jdf.queryExecution().toRdd().count()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # The one window numbers units of the same hash.
    assert len(re.findall(r"\bWindow \[", text)) <= 1 and "window_size" not in "".join(re.findall(r"Sort \[.*?\]", text))


def test_chunks_of_units(monkeypatch):
    """Units in many small chunks and batches, some longer than a chunk, some null or empty."""
    monkeypatch.setattr(literal, "CHUNK_WORDS", 40)
    lines = [*random_texts(5), "å a " * 60, "", "x y", "z " * 50]
    units = [line.split() for line in lines] + [None]
    copies = [1 + i % 3 for i in range(len(units))]
    batches = [
        pa.record_batch({"copies": pa.array(copies[i : i + 17], pa.int64()), "words": pa.array(units[i : i + 17], pa.list_(pa.string()))})
        for i in range(0, len(units), 17)
    ]
    found = Counter()
    for batch in literal._in_tasks(2, 10, 7)(batches):
        for r in batch.to_pylist():
            assert 0 <= r["bucket"] < 7
            entries = zip(r["words1"].split(" "), r["words2"].split(" "), r["sizes"], r["doublings"], r["counts"], strict=True)
            for one, two, size, doublings, count in entries:
                found[size, one, two] += count * 2**doublings
    expected = Counter()
    for words, n in zip(units, copies):
        for k in range(2, 11):
            for (a, b), count in fold(words or [], k):
                expected[k, a, b] += count * n
    assert found == expected


def test_a_pair_has_one_bucket(spark):
    words = pa.array([["a", "b", "a"], ["b", "a", "b"]], pa.list_(pa.string()))
    both = [b for i in range(2) for b in literal._blocks(pa.array([1]), words.slice(i, 1), 2, 2, 1000)]
    buckets = {(r["words1"], r["words2"]): set() for b in both for r in b.to_pylist()}
    for b in both:
        for r in b.to_pylist():
            buckets[r["words1"], r["words2"]].add(r["bucket"])
    assert all(len(found) == 1 for found in buckets.values())


def test_partitions_by_size(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(50_000).selectExpr("sha2(CAST(id AS string), 256) AS text").repartition(2).write.parquet(path)
    df = spark.read.parquet(path)
    assert stored_bytes(df) > 1_000_000
    # A join is as large as what it reads together, not the product.
    assert stored_bytes(df.crossJoin(df.withColumnRenamed("text", "t"))) == 2 * stored_bytes(df)
    assert partitions(df, 100_000) == -(-stored_bytes(df) // 100_000) and partitions(df, 1 << 40) == 4  # cores
    assert np.isfinite(stored_bytes(spark.createDataFrame([(1,)], "a int")))


def test_pieces_of_a_table_do_not_grow(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(50_000).selectExpr("sha2(CAST(id AS string), 256) AS text").write.parquet(path)
    monkeypatch.setattr(inputs, "SPREAD_BYTES", 100_000, raising=False)
    assert inputs.spread(spark.read.parquet(path)).rdd.getNumPartitions() > 10


def test_words_with_separators_in_canonical_sums(spark, rows):
    units = spark.createDataFrame([(["1:a", ":", "12", ":", "1:a"],)], "words array<string>")
    pairs = tl.endpoint_pairs(units, kmax=3)
    found = rows(tl.count_pairs(pairs, copies=None, windows=range(2, 4)))
    assert found == rows(tl.count_pairs(pairs, copies=None)) and (2, "1:a", ":", 2) in found
