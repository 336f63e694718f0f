"""One query per operator, over the whole ``documents`` table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import documents
from tagloom.llm.decontamination import contamination_report
from tagloom.llm.divergence import divergence
from tagloom.llm.exact_dedup import exact_dedup
from tagloom.llm.id_files import id_files
from tagloom.llm.languages import identify
from tagloom.llm.mixing import in_training_order, plan_mix
from tagloom.llm.near_dedup import near_duplicates
from tagloom.llm.packing import pack
from tagloom.llm.quality import judged
from tagloom.llm.repeats import remove_repeats
from tagloom.llm.sharding import shard_documents
from tagloom.llm.token_counts import token_counts
from tagloom.llm.vector_codes import digest, train_codes

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_patched_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_files(documents(spark, sf_dir), VOCABULARY, end_id=2)


def op2_fast_sketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir), words=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op4_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = plan_mix(documents(spark, sf_dir))
    placed = plan.withColumn("first_position", F.try_element_at("positions", F.lit(1)))
    ordered = in_training_order(placed, "first_position", "doc_id", "content")
    return ordered.select("doc_id", "size", "source_size", "target", "taken", "first_position")


def op5_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(documents(spark, sf_dir))


def op6_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir), shards=8)


def op7_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), VOCABULARY, window=1024, end_id=0)


def op8_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(documents(spark, sf_dir), threshold=100)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_subword_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


def op10_heap_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), VOCABULARY, limit=1024)


QUERIES = {
    f.__name__: f
    for f in (
        op1_patched_blocks,
        op2_fast_sketch_near_dedup,
        op3_exact_dedup,
        op4_curriculum_mix,
        op5_rule_ledger,
        op6_hash_tree_shards,
        op7_sum_of_squares_packing,
        op8_prefix_doubling,
        op9_subword_languages,
        op10_heap_token_counts,
    )
}


def op11_equal_average_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = train_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    totals = rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return rows.join(totals, rows["label"].eqNullSafe(totals["_label"])).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )


QUERIES[op11_equal_average_codes.__name__] = op11_equal_average_codes


def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination_report(documents(spark, sf_dir), benchmark, window=10)


QUERIES[op12_benchmark_decontamination.__name__] = op12_benchmark_decontamination


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(documents(spark, sf_dir), min_docs=3, top=200)


QUERIES[op13_source_divergence.__name__] = op13_source_divergence
