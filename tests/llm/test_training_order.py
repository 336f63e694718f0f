from tagloom.llm.queries import op4_curriculum_mix


def test_op4_comes_in_training_order(spark):
    parts = op4_curriculum_mix(spark, "/root/testdata/sf0.001").select("first_position", "doc_id").rdd.glom().collect()
    places = [(r.first_position is None, r.first_position or 0.0, r.doc_id) for part in parts for r in part]
    assert len(places) == 200 and places == sorted(places)
