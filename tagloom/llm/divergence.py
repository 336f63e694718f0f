"""Source divergence audit: how far each source's term distribution lies from its language's and the others'.

Per language, the kept terms are those in at least ``MIN_DOCS`` of its
documents (V of them). A group (language, source) gives every kept term a
smoothed share ``p = 1 + floor(SCALE * (count + 1) / (N + V))``, N being the
group's occurrences of kept terms; a language does the same over all its
sources. ``f(p, q) = floor((p - q)^2 / q)`` compares two shares; all arithmetic
is exact.

Part ``term`` lists, per group, its kept terms with count > 0 whose share is
above the language's, by ``f``. Part ``pair`` sums ``f`` over all kept terms
for every ordered pair of sources of a language. Most counts are zero, so a
pair's sum is ``V * f(base, base')`` for two zero counts, plus corrections for
the terms that one or both sources have:

* one source has the term: a row per (source, count) with its number of terms,
  met with every other source of the language;
* both have it: term rows (a term's nonzero counts, in a fixed order of
  sources) are inserted into a frequent-pattern tree; equal rows become one
  path with a multiplicity, and paths with equal beginnings share their nodes.
  Each node meets each of its ancestors once and adds, times the number of
  terms through the node, what both counts being nonzero changes for that pair.

Spark does all of it with aggregations and joins: the tree's nodes are the
distinct prefixes of term rows, counted by a grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import staged

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
# Groups (language, source) up to this many rows are broadcast where they meet each other.
BROADCAST_GROUPS = 200_000
SPREAD = 64

# Fixed values of the contract: terms are runs of ASCII letters and all non-ASCII; A-Z lower-cased.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
NOT_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def terms(text: str = "text") -> Column:
    """Terms of a text: runs between characters outside the term class (A-Z lowered first)."""
    parts = F.split(F.translate(_text(text), UPPER, LOWER), NOT_TERM)
    return F.array_remove(parts, "")


def share(count: str, total: str, kept: str) -> Column:
    """``1 + floor(SCALE * (count + 1) / (total + kept))`` of columns by name, exact beyond 64-bit products."""
    return F.expr(f"CAST((CAST({count} + 1 AS DECIMAL(38,0)) * {SCALE}) div ({total} + {kept}) + 1 AS BIGINT)")


def gap(p: str, q: str) -> Column:
    """``floor((p - q)^2 / q)`` of columns by name; shares are at most SCALE + 1, so the square fits in 64 bits."""
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})")


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, count, docs: occurrences and documents of each term per group (nulls as '').

    One pass: a document's terms are sorted, and a term that differs from the
    one before it in that order is the document's first of it. So a single
    grouping by (lang, source, term), combined within each task before the
    shuffle, counts both occurrences and documents. Nothing is keyed by document.
    """
    rows = docs.select(_text("lang").alias("lang"), _text("source").alias("source"), F.sort_array(terms()).alias("_t"))
    each = rows.select("lang", "source", "_t", F.posexplode("_t").alias("_p", "term"))
    first = F.when(F.col("_p") == 0, True).otherwise(F.try_element_at("_t", F.col("_p")) != F.col("term"))
    return each.groupBy("lang", "source", "term").agg(
        F.count(F.lit(1)).alias("count"), F.sum(first.cast("long")).alias("docs")
    )


def _meet(left: DataFrame, right: DataFrame, on: list[str], small: bool) -> DataFrame:
    return left.join(F.broadcast(right) if small else right, on)


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank (see the module).

    Null text, lang and source read as ''. Every occurring group appears, even
    one without terms: its pairs have value 0 where its language keeps no term.
    A language with one source has no pair rows. Ranks count from 1 per (lang,
    source, part) by value descending, then item ascending by UTF-8 bytes;
    ``term`` rows stop at rank ``top``. Repeated rows count as documents each.
    An empty table gives an empty one; very long texts are read whole; other
    columns of ``docs`` are not read.
    """
    # A term's rows of a language, one per source, meet once and carry its sums from then on.
    term = Window.partitionBy("lang", "term")
    present = term_counts(docs).select(
        "lang",
        "source",
        "term",
        "count",
        F.sum("count").over(term).alias("lang_count"),
        F.sum("docs").over(term).alias("_docs"),
        (F.col("source") == F.min("source").over(term)).alias("first"),
    )
    present = staged(present.where(F.col("_docs") >= min_docs).drop("_docs"), "present")
    vocab = present.where("first").groupBy("lang").agg(F.count(F.lit(1)).alias("V"), F.sum("lang_count").alias("lang_N"))
    totals = present.groupBy("lang", "source").agg(F.sum("count").alias("N"), F.count(F.lit(1)).alias("n_terms"))
    groups = (
        docs.select(_text("lang").alias("lang"), _text("source").alias("source"))
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(vocab, "lang", "left")
        .select(
            "lang",
            "source",
            F.coalesce("N", F.lit(0)).alias("N"),
            F.coalesce("V", F.lit(0)).alias("V"),
            F.coalesce("n_terms", F.lit(0)).alias("n_terms"),
        )
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n_terms"), "source")
    groups = staged(
        groups.withColumn("base", F.when(F.col("V") > 0, share("0", "N", "V")))
        .withColumn("place", F.row_number().over(order)),
        "groups",
    )
    small = groups.count() <= BROADCAST_GROUPS
    g = groups.select("lang", "source", "N", "V", "base", "place")
    return _terms_part(present, g, vocab, top, small).unionByName(_pairs_part(present, g, small))


def _terms_part(present: DataFrame, g: DataFrame, vocab: DataFrame, top: int, small: bool) -> DataFrame:
    g = g.join(vocab.select("lang", "lang_N"), "lang")
    rows = _meet(present, g, ["lang", "source"], small).select(
        "lang", "source", "term", share("count", "N", "V").alias("p"), share("lang_count", "lang_N", "V").alias("q")
    )
    rows = rows.where(F.col("p") > F.col("q"))
    rows = rows.select("lang", "source", F.col("term").alias("item"), gap("p", "q").alias("value"))
    # Top terms per group in two steps, so that no task ranks all terms of a large group.
    best = [F.desc("value"), F.col("item").cast("binary")]
    spread = Window.partitionBy("lang", "source", F.pmod(F.xxhash64("item"), F.lit(SPREAD))).orderBy(*best)
    rows = rows.withColumn("_r", F.row_number().over(spread)).where(F.col("_r") <= top).drop("_r")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*best)))
    return ranked.where(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


def _pairs_part(present: DataFrame, g: DataFrame, small: bool) -> DataFrame:
    other = g.select(
        "lang", F.col("source").alias("item"), F.col("N").alias("N2"), F.col("base").alias("base2"), F.col("place").alias("place2")
    )
    both = g.join(other, "lang").where(F.col("source") != F.col("item"))
    both = staged(both.withColumn("_zero", F.coalesce(gap("base", "base2"), F.lit(0))), "pairs-of-groups")
    baseline = both.select("lang", "source", "item", (F.col("V").cast("decimal(38,0)") * F.col("_zero")).alias("v"))

    # One source has the term: (source, count, terms) meets every other source.
    singles = _meet(present, g, ["lang", "source"], small).groupBy("lang", "source", "count", "N", "V").agg(
        F.count(F.lit(1)).alias("m")
    )
    singles = singles.select("lang", "source", "count", "m", share("count", "N", "V").alias("p"))
    pairs = both.select("lang", "source", "item", "base", "base2", "_zero", "N2", "V")
    ahead = singles.join(pairs, ["lang", "source"]).select(
        "lang", "source", "item", (F.col("m") * (gap("p", "base2") - F.col("_zero"))).cast("decimal(38,0)").alias("v")
    )
    mirrored = singles.select("lang", F.col("source").alias("item"), "m", F.col("p").alias("p2"))
    behind = mirrored.join(pairs, ["lang", "item"]).select(
        "lang", "source", "item", (F.col("m") * (gap("base", "p2") - F.col("_zero"))).cast("decimal(38,0)").alias("v")
    )
    corrected = _tree_corrections(present, g, pairs, small)
    value = baseline.unionByName(ahead).unionByName(behind).unionByName(corrected)
    value = value.groupBy("lang", "source", "item").agg(F.coalesce(F.sum("v"), F.lit(0)).cast("long").alias("value"))
    # Sources without any other get no row; every pair has its baseline row.
    rank = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.col("item").cast("binary"))
    return value.select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(rank).alias("rank")
    )


def _tree_corrections(present: DataFrame, g: DataFrame, pairs: DataFrame, small: bool) -> DataFrame:
    """lang, source, item, v: what two nonzero counts of a term change, summed by frequent-pattern tree nodes."""
    placed = _meet(present, g.select("lang", "source", "place"), ["lang", "source"], small)
    rows = placed.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("place", "count"))).alias("row"))
    paths = rows.where(F.size("row") > 1).groupBy("lang", "row").agg(F.count(F.lit(1)).alias("m"))
    # Nodes below the root's children: distinct prefixes of two entries or more, with the terms through them.
    depth = F.sequence(F.lit(2), F.size("row"))
    nodes = paths.select("lang", "m", F.explode(F.transform(depth, lambda j: F.slice("row", 1, j))).alias("node"))
    nodes = staged(nodes.groupBy("lang", "node").agg(F.sum("m").alias("m")), "tree-nodes")
    last = F.element_at("node", -1)
    met = nodes.select(
        "lang",
        "m",
        last["place"].alias("place2"),
        last["count"].alias("count2"),
        F.explode(F.slice("node", 1, F.size("node") - 1)).alias("up"),
    ).select("lang", "m", "place2", "count2", F.col("up.place").alias("place"), F.col("up.count").alias("count"))
    met = met.groupBy("lang", "place", "count", "place2", "count2").agg(F.sum("m").alias("m"))
    at = g.select("lang", "place", "source", "N", "V")
    at2 = g.select("lang", F.col("place").alias("place2"), F.col("source").alias("item"), F.col("N").alias("N2"))
    met = _meet(_meet(met, at, ["lang", "place"], small), at2, ["lang", "place2"], small)
    met = met.select(
        "lang",
        "source",
        "item",
        "m",
        share("count", "N", "V").alias("p"),
        share("count2", "N2", "V").alias("p2"),
    )
    base = pairs.select("lang", "source", "item", "base", "base2")
    one_way = met.join(base, ["lang", "source", "item"]).select(
        "lang",
        "source",
        "item",
        (
            F.col("m").cast("decimal(38,0)")
            * (gap("p", "p2") - gap("p", "base2") - gap("base", "p2") + gap("base", "base2"))
        ).alias("v"),
    )
    other_way = met.select(
        "lang", F.col("item").alias("source"), F.col("source").alias("item"), "m", F.col("p2").alias("p"), F.col("p").alias("p2")
    ).join(base, ["lang", "source", "item"]).select(
        "lang",
        "source",
        "item",
        (
            F.col("m").cast("decimal(38,0)")
            * (gap("p", "p2") - gap("p", "base2") - gap("base", "p2") + gap("base", "base2"))
        ).alias("v"),
    )
    return one_way.unionByName(other_way)
