"""Sums that are shuffled as packed blocks and added up per partition."""

from collections import Counter

import pyarrow as pa
import pytest
from test_pairs import random_texts

import tagloom as tl
from tagloom.operators import literal
from tagloom.plans import word_pairs as plans
from tagloom.streaming import jobs


@pytest.fixture
def units():
    lines = [*random_texts(5), "å a " * 60, "", "x y", "z " * 50]
    return [line.split() for line in lines] + [None], [1 + i % 3 for i in range(len(lines) + 1)]


def batches(words, copies, each=17):
    return [
        pa.record_batch({"copies": pa.array(copies[i : i + each], pa.int64()), "words": pa.array(words[i : i + each], pa.list_(pa.string()))})
        for i in range(0, len(words), each)
    ]


@pytest.mark.parametrize("window", [literal._window, literal._plain_window])
def test_packed_blocks_are_those_of_the_tasks(units, monkeypatch, window):
    """F3, F6, F8: packing and adding up lose no sum, whatever the chunks and the sums held."""
    monkeypatch.setattr(literal, "CHUNK_WORDS", 40)
    expected = Counter()
    for batch in literal._in_tasks(2, 10, 7, window)(batches(*units)):
        for r in batch.to_pylist():
            for one, two, size, doublings, count in zip(r["words1"].split(" "), r["words2"].split(" "), r["sizes"], r["doublings"], r["counts"], strict=True):
                expected[size, one, two, doublings] += count
    for held in (1, 1000, 10**9):
        monkeypatch.setattr(literal, "HELD", held)
        rows = [r for b in literal._summed(literal._packed(2, 10, 7, window)(batches(*units))) for r in b.to_pylist()]
        found = {(r["window_size"], r["word1"], r["word2"], r["doublings"]): r["word_count"] for r in rows}
        assert len(found) == len(rows) and found == dict(expected)


def test_canonical_blocks_cut_long_units(units, monkeypatch):
    """a unit longer than a chunk is counted in pieces, each window once."""
    expected = Counter()
    for words, n in zip(*units):
        for k in range(2, 11):
            for a, b in zip(words or [], (words or [])[k - 1 :]):
                expected[k, min(a, b), max(a, b)] += n
    for chunk in (1, 3, 40, 10**6):
        monkeypatch.setattr(literal, "CHUNK_WORDS", chunk)
        found = Counter()
        for b in literal._summed(literal._packed(2, 10, 5, literal._plain_window)(batches(*units))):
            for r in b.to_pylist():
                assert r["doublings"] == 0
                found[r["window_size"], r["word1"], r["word2"]] += r["word_count"]
        assert found == expected


def test_large_inputs_are_counted_in_blocks(spark, rows, monkeypatch):
    """the same rows and types, by one shuffle of blocks instead of a row per pair."""
    df = spark.createDataFrame([(i, f"{t}\nb a") for i, t in enumerate([*random_texts(7), None, "", "å ä"])], "tweet_id long, text string")
    lexicon = spark.createDataFrame([("a", None), ("b", "c d")], "form string, lemma string")
    settings = [{}, {"unit": "line"}, {"combine": True}, {"kmin": 3, "kmax": 40}, {"lexicon": lexicon}]
    small = [tl.word_pairs(df, **s) for s in settings]
    monkeypatch.setattr(plans, "BLOCK_BYTES", 0)
    for before, options in zip(small, settings):
        blocks = tl.word_pairs(df, **options)
        assert "MapInArrow" in blocks._jdf.queryExecution().executedPlan().toString()
        assert blocks.dtypes == before.dtypes and rows(blocks) == rows(before) and rows(before)
    with pytest.raises(ValueError):
        tl.word_pairs(df, kmin=3, kmax=2)


def test_literal_sums_are_added_up_outside_sorts_and_hash_tables(spark):
    """F6, F8: what is shuffled is a binary value per block; nothing sums it row by row after that."""
    df = spark.createDataFrame([(1, "a b a b")], "tweet_id long, text string")
    plan = tl.word_pairs(df, mode="literal")._jdf.queryExecution().executedPlan().toString()
    after = plan.split("Exchange hashpartitioning(bucket")[0]
    assert "packed" in plan and "Aggregate" not in after


@pytest.mark.parametrize("mode", ["canonical", "literal"])
def test_totals_of_loads_are_shuffled_in_blocks(spark, rows, tmp_path, monkeypatch, mode):
    """the same totals, types and order of columns, compacted or not."""
    out = str(tmp_path / "out")
    for n in range(3):
        df = spark.createDataFrame([(i, t) for i, t in enumerate([*random_texts(n)[:20], "å b b b å"])], "tweet_id long, text string")
        tl.word_pairs(df, mode=mode).write.parquet(f"{out}/delta/load_id={n}")
        spark.sql("SELECT 'x' AS batch_name, 'SUCCESS' AS batch_status").write.parquet(f"{out}/batches/load_id={n}/step=2")
    before = tl.pair_totals(spark, out, mode)
    expected = rows(before)
    monkeypatch.setattr(jobs, "BLOCK_BYTES", 0)
    for held in (50, 10**9):
        monkeypatch.setattr(literal, "HELD", held)
        after = tl.pair_totals(spark, out, mode)
        assert "MapInArrow" in after._jdf.queryExecution().executedPlan().toString()
        assert after.dtypes == before.dtypes and rows(after) == expected and expected
    tl.compact_pairs(spark, out, mode)
    assert rows(tl.pair_totals(spark, out, mode)) == expected
