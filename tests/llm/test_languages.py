import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tagloom.llm.languages import Model, fit, identify, predict, sample, subword_counts

SYLLABLES = {"aa": ["ka", "ro", "mi", "tu"], "bb": ["ing", "the", "ed", "ly"], "cc": ["ção", "ñe", "ü", "ße"]}


def labelled(spark, n=600):
    rng = random.Random(4)
    rows = []
    for doc in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        words = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(30)]
        rows.append((doc, " ".join(words), lang if rng.random() < 0.8 else None, lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, truth string").repartition(3)


def test_held_out_accuracy(spark):
    docs = labelled(spark)
    found = {r.doc_id: r for r in identify(docs).collect()}
    for r in docs.collect():
        got = found[r.doc_id]
        assert got.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert got.lang_pred == r.truth and 0.5 < got.score <= 1


def test_given_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = docs.join(identify(docs), "doc_id").where("held_out AND lang IS NOT NULL")
    assert found.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


def test_labels_are_no_inputs(spark):
    """Of the held-out fold only texts matter, and nothing of it is learnt."""
    docs = labelled(spark)
    wrong = docs.withColumn(
        "lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit("zz")).otherwise(F.col("lang"))
    )
    assert sorted(map(tuple, identify(docs).collect())) == sorted(map(tuple, identify(wrong).collect()))


def test_rejection(spark):
    docs = labelled(spark)
    model = fit(docs)
    odd = spark.createDataFrame([(1, "zzqx wvvk jjxq"), (2, "therolying theed")], "doc_id long, text string")
    found = {r.doc_id: r for r in predict(odd, model).collect()}
    assert not found[1].accepted and found[1].lang_pred in SYLLABLES


def test_sample_is_bounded(spark):
    docs = labelled(spark, 900).withColumn("doc_id", F.lit(1))  # one id: chance takes all or none of them
    assert sample(docs, 5, 2).count() <= 10
    docs = labelled(spark, 900)
    assert 20 < sample(docs, 20, 3).count() <= 60 and sample(docs, 1000, 1).select("lang").distinct().count() == 1


def test_edge_rows(edge, edge_rows, empty):
    found = identify(edge).collect()
    assert len(found) == len(edge_rows)
    for r in found:
        if r.doc_id in (20, 21, 22, 24):
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
        else:
            assert r.lang_pred in ("en", "de", "fr") and 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert identify(empty).count() == 0
    assert {r.lang_pred for r in identify(edge.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_scores_do_not_depend_on_batches():
    rng = np.random.default_rng(3)
    weights = rng.integers(-(10**6), 10**6, (1 << 15, 3))
    model = Model(["a", "b", "c"], weights, np.zeros(3), 0.7, 0.0)
    texts = ["one two three", None, "", "x" * 40_000 + " y", "déjà vu 123", "One  TWO,three"]
    together = model.scores(texts)
    assert np.array_equal(together, np.concatenate([model.scores([t]) for t in texts]))
    assert np.array_equal(together[0], together[5])
    used, times = subword_counts("one two three")
    assert times.sum() == 19 and len(used) <= 19  # a gram of 3 around each letter, of 4 around each pair


def test_small_samples_are_calibrated_too(spark):
    """Twenty labelled rows get a temperature and a rejection threshold from cross-validation, as large samples do."""
    docs = labelled(spark, 30)
    model = fit(docs)
    assert sample(docs).count() < 50
    assert model.threshold > 0 and model.temperature != 1.0
    odd = spark.createDataFrame([(1, "zzqx wvvk jjxq")], "doc_id long, text string")
    assert not predict(odd, model).first().accepted
