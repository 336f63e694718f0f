from tagloom.llm.divergence import term_counts


def test_terms_are_sorted_without_a_lambda(spark):
    """A lambda would be called once per comparison of two terms, outside generated code."""
    docs = spark.createDataFrame([("b a b", "en", "s")], "text string, lang string, source string")
    counted = term_counts(docs)
    assert "lambda" not in counted._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, counted.collect())) == [("en", "s", "a", 1, 1), ("en", "s", "b", 2, 1)]
