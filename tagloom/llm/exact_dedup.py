"""Exact duplicates by skew-safe combining, in DataFrame operations only.

1. Every map task combines its own rows of one text (partial aggregation).
2. These winners meet by (digest, salt, text). Only digests that hold more than
   one in ``HOT_SHARE`` of all rows are salted, so there are at most
   ``HOT_SHARE`` of them and their list may be broadcast.
3. The salt winners of those are combined globally by (digest, text).

Each stage groups by the full text, so a digest never decides alone. The winners
are stored without their texts and joined to the rows' digests. Should texts of
different content share a digest (which the first table of winners shows, as it
then holds the digest twice), the texts themselves take the digests' place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import SPACE, once_per_key, staged, text_or_empty, with_key

HOT_SHARE = 10_000
SALTS = 64

# Runs of white space that are not already one space.
_TO_ONE_SPACE = rf"[\x09-\x0D][{SPACE}]*|\x20[{SPACE}]+"


def normalised(text: str = "text") -> Column:
    """The text with each run of white space as one space; null counts as empty."""
    return F.regexp_replace(text_or_empty(text), _TO_ONE_SPACE, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _winners(rows: DataFrame, digests: DataFrame) -> DataFrame:
    """key, keep_id, group_size: one row per text of ``rows`` (doc_id, key, norm)."""
    count = digests.count()
    hot = (
        digests.groupBy("key")
        .count()
        .where((F.col("count") > 1) & (F.col("count") > count // HOT_SHARE))
        .select("key", F.lit(True).alias("hot"))
    )
    # By the id alone, so that a task run again puts every row into the same salt; rows that share an
    # id are combined within their map task before the shuffle.
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).otherwise(0)
    salted = (
        rows.join(F.broadcast(hot), "key", "left")
        .withColumn("salt", salt)
        .groupBy("key", "hot", "salt", "norm")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    salted = staged(
        salted.select("key", "hot", "keep_id", "group_size", F.when(F.col("hot"), F.col("norm")).alias("norm")),
        "salted",
    )
    combined = (
        salted.where("hot")
        .groupBy("key", "norm")
        .agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    )
    columns = ("key", "keep_id", "group_size")
    return salted.where("hot IS NULL").select(*columns).unionByName(combined.select(*columns))


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of ``docs``.

    ``docs`` needs doc_id and text; other columns are ignored. Null texts equal
    empty ones. Null ids count as larger than any other. If the row that stays
    comes several times with one id, exactly one of these rows is ``kept``. An
    empty table gives an empty one. ``digest`` may be weak; the result is the same.
    """
    rows = docs.select("doc_id", normalised().alias("norm")).withColumn("key", digest(F.col("norm")))
    sha = F.col("key") if digest is sha256 else sha256(F.col("norm"))
    listed = staged(
        rows.select("doc_id", "key", sha.alias("sha"), F.monotonically_increasing_id().alias("row_id")), "digests"
    )
    winners = staged(_winners(rows, listed.select("key")), "winners")
    if not winners.groupBy("key").count().where("count > 1").isEmpty():
        return exact_dedup(docs, digest=lambda norm: norm.cast("binary"))

    # Of repeated rows of one id the first one stays.
    first = listed.groupBy("key", "doc_id").agg(F.min("row_id").alias("first_row"))
    first = first.join(winners, "key").where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    found = listed.join(first.drop("doc_id"), "key")
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row_id") == F.col("first_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text an earlier id has; columns as they were.

    Of repeated rows (one id, equal texts) one stays.
    """
    kept = exact_dedup(docs).where("kept")
    stay = kept.select(F.col("doc_id").alias("_id"), F.unhex("text_sha256").alias("_sha"))
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_sha"))
    keyed = once_per_key(with_key(docs, sha256(normalised())))
    return keyed.join(stay, same, "left_semi").select("_all.*")
