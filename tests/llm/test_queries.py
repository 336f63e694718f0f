"""The registered queries against their SQL, and what the entry offers."""

import public_tokenizers
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tagloom.llm.oracle import ORACLE
from tagloom.llm.queries import QUERIES
from workload.check import connect, difference


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, small, name):
    assert difference(QUERIES[name](spark, small), connect(small), ORACLE[name]) == ""


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_vocabulary_is_there():
    assert public_tokenizers.path("byte_bpe_50k.json")
