import pytest

import corpus_pipeline
import test_exact_dedup
import test_near_settings
import test_quality
import test_tokens
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(test_tokens.PATH)


def stages(spark, docs, folder):
    """What each stage returns, written and read as the next one's input."""
    out = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, "").write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        out.append(docs)
    return out


def test_stages_against_brute_force(spark, small, tmp_path, library):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    good, exact, near, mixed, packed = stages(spark, docs, tmp_path)
    rows = {r.doc_id: r for r in docs.collect()}

    ids = {r.doc_id for r in good.collect()}
    for doc, r in rows.items():
        words, _, symbols, _, repeated = test_quality.measured(r.text)
        if words < 10 or 100 * repeated > 20 * words or 100 * symbols > 25 * words:
            assert doc not in ids

    def left(expected, ids):
        return {row[0] for row in expected([(d, rows[d].text) for d in sorted(ids)]) if row[3]}

    now = {r.doc_id for r in exact.collect()}
    assert now == left(test_exact_dedup.expected, ids)
    last = {r.doc_id for r in near.collect()}
    assert last == test_near_settings.left([(d, rows[d].text) for d in now], 5)
    taken = [r.doc_id for r in mixed.collect()]
    assert set(taken) <= last and max(map(taken.count, last)) <= 2
    for stage in (good, exact, near, mixed):
        assert stage.columns == docs.columns
    short = test_tokens.check_pieces(packed.collect(), [(r.doc_id, r.text) for r in mixed.collect()], library)
    assert short <= mixed.rdd.getNumPartitions()

    whole = corpus_pipeline.run(spark, small)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert whole.columns == packed.columns
    assert whole.select("doc_tokens").groupBy().sum().first() is not None
    assert whole.selectExpr("sum(length)").first() == packed.selectExpr("sum(length)").first()
    assert {r[0] for r in whole.select(key[0]).collect()} == set(taken)


def test_edge_rows(spark, edge, empty, tmp_path):
    *kept, packed = stages(spark, edge.drop("n_chars"), tmp_path)
    for docs in kept:
        assert docs.columns == edge.drop("n_chars").columns
    assert packed.count() > 0
    assert stages(spark, empty, tmp_path / "empty")[-1].count() == 0
