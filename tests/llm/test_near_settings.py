import pytest

import corpus_pipeline
import test_near_dedup
from tagloom.llm.near_dedup import near_duplicates
from tagloom.llm.queries import op2_fast_sketch_near_dedup


def shingle_set(text, size):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def left(rows, size, percent=80):
    """Ids that stay of rows of different ids, by comparing all pairs."""
    rows = sorted(rows)
    sets = [shingle_set(text, size) for _, text in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = sorted((find(i), find(j)))
                label[y] = x
    return {doc for i, (doc, _) in enumerate(rows) if find(i) == i}


def between():
    """A text and one with another word in its middle: 35 of 43 shingles of four words are shared, 33 of 43 of five."""
    words = [f"w{i}" for i in range(42)]
    return [(1, " ".join(words)), (2, " ".join([*words[:20], "other", *words[21:]]))]


def test_stage_compares_five_words(spark):
    rows = between() + [(doc + 10, text) for doc, text in test_near_dedup._chains(6, 4, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id for r in corpus_pipeline.near_stage(spark, docs, "").collect()}
    assert {1, 2} <= found
    assert found == left(rows, 5) != left(rows, 4)


def test_stage_on_given_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").dropDuplicates(["doc_id"])
    found = {r.doc_id for r in corpus_pipeline.near_stage(spark, docs, "").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found == left(rows, 5) != left(rows, 4)


def test_op2_compares_four_words(spark, tmp_path):
    spark.createDataFrame(between(), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = op2_fast_sketch_near_dedup(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.component_id, r.n_shingles) for r in found} == {(1, 1, 39), (2, 1, 39)}


def test_percent(spark):
    docs = spark.createDataFrame(between(), "doc_id long, text string")
    assert near_duplicates(docs, 4, 82).where("kept").count() == 2
    for words, percent in ((0, 80), (4, 79), (4, 101)):
        with pytest.raises(ValueError):
            near_duplicates(docs, words, percent)


def test_null_and_shared_ids_keep_different_texts(spark):
    """Components are told apart by root: unrelated texts with null or shared ids all stay."""
    texts = [" ".join(f"{k}{i}" for i in range(30)) for k in "abcd"]
    for ids in ([None, None, None, 5], [9, 9, 9, 5]):
        rows = list(zip(ids, texts)) + [(ids[0], texts[0])]  # and a repeated row
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
        kept = sorted(map(tuple, corpus_pipeline.near_stage(spark, docs, "").collect()), key=repr)
        assert kept == sorted(set(zip(ids, texts)), key=repr)
