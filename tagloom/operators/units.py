"""Units of text within which words are paired, and their lemmas."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.text import tokens, words
from tagloom.operators.keys import one_per_key

UNIT_KEYS = ("unit_hash", "unit_no")


def units(df: DataFrame, keys: tuple[str, ...] = (), text: str = "text", unit: str = "record") -> DataFrame:
    """Cut texts into units: ``keys``, unit_no, text.

    ``unit="record"`` takes a text as one unit, ``"line"`` one line of it. Lines
    must be cut before cleaning, which turns line breaks into spaces.
    """
    if unit == "record":
        return df.select(*keys, F.lit(0).alias("unit_no"), F.col(text).alias("text"))
    if unit == "line":
        return df.select(*keys, F.posexplode(F.split(text, "\n")).alias("unit_no", "text"))
    raise ValueError(f"unit must be 'record' or 'line', not {unit!r}")


def with_words(df: DataFrame, **flags: bool) -> DataFrame:
    """Replace ``text`` by ``words``, its cleaned words.

    The generator keeps the optimizer from copying the cleaning expression into
    every later reference to ``words``.
    """
    keep = [c for c in df.columns if c != "text"]
    return df.select(*keep, F.explode(F.array(words("text", **flags))).alias("words"))


def distinct_units(df: DataFrame) -> DataFrame:
    """Each different unit text once, with the number of its ``copies``.

    What is counted within a unit depends on its text alone, so copies need no
    work of their own. They are combined before the shuffle, which also spreads
    the units evenly, whatever the sizes of the input's splits.
    """
    return (
        df.where(F.col("text").isNotNull())
        .groupBy("text")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def keyed_units(distinct: DataFrame) -> DataFrame:
    """Add the key (unit_hash, unit_no) to the rows of :func:`distinct_units`.

    The hash partitions the data and keeps long texts out of later sort keys;
    the number tells apart the (very few) texts that share a hash, so the key is
    exact. Later steps that group or sort within a unit reuse this partitioning.
    """
    same_hash = Window.partitionBy("unit_hash").orderBy("text")
    return distinct.withColumn("unit_hash", F.xxhash64("text")).withColumn(
        "unit_no", F.row_number().over(same_hash)
    )


def lemmatise(
    units: DataFrame,
    lexicon: DataFrame,
    keys: tuple[str, ...] = UNIT_KEYS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Replace the ``words`` of each unit by their lemmas: ``keys``, ``keep``, words.

    ``lexicon`` has (form, lemma). A word that is no form of it stays; a form
    with a null or empty lemma is dropped; a lemma of several words gives
    several. If a form is listed twice the smaller lemma counts. Units without
    a word left are not returned. ``keys`` must identify a unit and ``keep``
    names further columns that are constant within it.

    The lexicon has no broadcast hint: Spark broadcasts it when its size allows
    and joins by sorting otherwise (splitting frequent words at run time).
    """
    lemmas = one_per_key(lexicon, "form", F.min("lemma").alias("lemma")).withColumn(
        "known", F.lit(True)
    )
    spoken = units.select(*keys, *keep, F.posexplode("words").alias("_pos", "form"))
    found = spoken.join(lemmas, "form", "left").withColumn(
        "lemma", F.when(F.col("known"), F.col("lemma")).otherwise(F.col("form"))
    )
    kept = found.where(F.length(F.trim("lemma")) > 0)
    ordered = F.array_sort(F.collect_list(F.struct("_pos", "lemma")))
    text = kept.groupBy(*keys, *keep).agg(ordered.alias("spoken")).select(
        *keys, *keep, F.array_join(F.col("spoken.lemma"), " ").alias("text")
    )
    return text.select(*keys, *keep, tokens("text").alias("words"))
