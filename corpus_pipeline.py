"""From documents to packed training sequences, stage by stage.

Every stage takes the documents that the one before kept, all columns, and its
decisions take effect in what it returns. :func:`run` writes what a stage returns
to the shared folder and reads it again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import tagloom
from tagloom.llm.common import documents, staged
from tagloom.llm.exact_dedup import drop_exact_duplicates
from tagloom.llm.mixing import mix
from tagloom.llm.near_dedup import drop_near_duplicates
from tagloom.llm.packing import pack
from tagloom.llm.quality import keep_good

# Ship the package with the tasks, so that workers need not have it installed.
cloudpickle.register_pickle_by_value(tagloom)

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the newest policy of the quality rules keeps.

    Null and empty texts have too few words and go. Repeated rows share a verdict.
    """
    return keep_good(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest id; of repeated rows one."""
    return drop_exact_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id; texts without words stay.

    Near duplicates are 80% similar in their shingles of five words (op2 has four).
    """
    return drop_near_duplicates(docs, words=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as the mix takes them (twice at most, or not at all)."""
    return mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 1024 tokens; a document that comes twice is packed twice."""
    return pack(docs, VOCABULARY, window=1024, end_id=0)


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# Similarity sketches and byte-pair tokens are beyond SQL: tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
