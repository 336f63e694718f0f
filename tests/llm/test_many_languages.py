import random

from pyspark.sql import functions as F

from tagloom.llm.languages import fit, held_out, predict, sample


def many(spark, n=70, each=8):
    """``n`` languages of words of their own, the last with a row less than the others."""
    rng = random.Random(11)
    rows = []
    for k in range(n):
        own = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(6)]
        for _ in range(each - (k == n - 1)):
            rows.append((" ".join(rng.choice(own) for _ in range(30)), f"l{k:03}"))
    docs = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "doc_id long, text string, lang string")
    return docs.repartition(3)


def test_every_language_is_learnt(spark):
    docs = many(spark)
    learnt = docs.where(~held_out())
    model = fit(docs)
    assert model.languages == sorted({r.lang for r in learnt.collect()}) and len(model.languages) > 64
    found = predict(learnt.drop("lang"), model).join(learnt, "doc_id")
    right = found.where("lang = lang_pred")
    assert right.select("lang").distinct().count() == len(model.languages)
    assert right.count() > 0.9 * learnt.count()


def test_rows_are_divided_among_languages(spark):
    docs = many(spark, 12, 30)
    found = sample(docs, 20, rows=60).groupBy("lang").count().collect()
    assert len(found) == 12 and max(r["count"] for r in found) <= 5
    # More languages than rows: one row of each.
    assert sorted(r["count"] for r in sample(docs, 20, rows=5).groupBy("lang").count().collect()) == [1] * 12


def test_repeated_ids_leave_no_language_out(spark):
    docs = many(spark, 12, 30).withColumn("doc_id", F.lit(None).cast("long"))
    ways = [sample(docs.repartition(n), 20, rows=60).toPandas() for n in (1, 4)]
    for found in ways:
        assert found["lang"].nunique() == 12 and len(found) <= 60
    keys = [sorted((r.lang, tuple(r.used), tuple(r.times)) for r in found.itertuples()) for found in ways]
    assert keys[0] == keys[1]
