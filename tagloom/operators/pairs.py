"""Pairs of words at the ends of a sliding window, and their counts.

A window of k words, moved by one word, pairs its first with its last word; the
words between are not paired. Two ways of counting:

``canonical``
    Unordered pair (word1 <= word2), number of occurrences.

``literal``
    Per unit, in order of position: of an unordered pair of different words that
    occurs n times, with f neighbouring occurrences in opposite orientation,
    n - f are counted, under the orientation of the last one. A pair of equal
    words counts 2^(n-1). Sums over units keep orientations apart. Powers of two
    are not multiplied out: a row has a count and a number of ``doublings`` (0 for
    different words), and stands for count * 2^doublings, so no n is too large.
    :func:`plain_counts` makes one number per pair of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.operators.units import UNIT_KEYS
from tagloom.schemas import MAX_WINDOW, MIN_WINDOW

FITS_32_BITS = 30  # fixed value: doublings of 1 that a signed 32-bit count can hold
MAX_SUMS = 32  # window sizes whose sums share a row


def endpoint_pairs(
    units: DataFrame,
    keys: tuple[str, ...] = (),
    kmin: int = MIN_WINDOW,
    kmax: int = MAX_WINDOW,
) -> DataFrame:
    """``keys``, window_size, pos, a, b for every window of every unit.

    Works row by row on ``words``; units shorter than ``kmin`` give no rows. Both
    generators stay in generated code, so no array of pairs is ever built and a
    unit may be of any length.
    """
    if not 1 <= kmin <= kmax:
        raise ValueError(f"bad window range {kmin}..{kmax}")
    n = F.size("words")
    starts = F.when(n >= kmin, F.sequence(F.lit(0), n - kmin))
    at = units.select(*keys, "words", F.explode(starts).alias("pos"))
    sizes = F.sequence(F.lit(kmin), F.least(F.lit(kmax), n - F.col("pos")))
    windows = at.select(*keys, "words", "pos", F.explode(sizes).alias("window_size"))
    end = F.col("pos") + F.col("window_size") - 1
    return windows.select(
        *keys,
        "window_size",
        "pos",
        F.get("words", F.col("pos")).alias("a"),
        F.get("words", end).alias("b"),
    )


def count_pairs(
    pairs: DataFrame,
    mode: str = "canonical",
    keys: tuple[str, ...] = UNIT_KEYS,
    copies: str | None = "copies",
    windows: range | None = None,
) -> DataFrame:
    """window_size, word1, word2, word_count from the rows of ``endpoint_pairs``.

    Literal mode has a column ``doublings`` before word_count. ``copies`` names the
    column with the number of copies of a unit (None: each counts once); ``keys``,
    needed for literal mode, identify a unit. ``windows``, if given, are the window
    sizes that occur; a row of any other size is an error.
    """
    if mode == "canonical":
        weight = F.lit(1) if copies is None else F.col(copies)
        found = pairs.select(
            "window_size",
            F.least("a", "b").alias("word1"),
            F.greatest("a", "b").alias("word2"),
            weight.cast("long").alias("counted"),
        )
        return _sum_up(found, windows, ("word1", "word2"))
    if mode != "literal":
        raise ValueError(f"mode must be 'canonical' or 'literal', not {mode!r}")
    same = F.col("word1") == F.col("word2")
    counted = F.when(same, F.lit(1)).otherwise(F.col("n") - F.col("turns")) * F.col("copies")
    found = _literal_per_unit(pairs, keys, copies).select(
        "window_size",
        "word1",
        "word2",
        F.when(same, F.col("n") - 1).otherwise(0).cast("int").alias("doublings"),
        counted.alias("counted"),
    )
    return _sum_up(found, windows, ("word1", "word2", "doublings"))


def plain_counts(literal: DataFrame) -> DataFrame:
    """window_size, word1, word2, word_count of the rows of literal mode, multiplied out.

    Raises an error when run if a count does not fit 64 bits.
    """
    keys = ("window_size", "word1", "word2")
    too_large = F.raise_error("a literal count does not fit 64 bits").cast("decimal(38,0)")
    one = F.col("word_count").cast("decimal(19,0)") * F.expr("shiftleft(1L, doublings)").cast("decimal(19,0)")
    rows = literal.select(*keys, F.when(F.col("doublings") < 63, one).otherwise(too_large).alias("value"))
    value = F.sum("value")
    fits = F.when(value <= F.lit(2**63 - 1), value).otherwise(too_large)
    return rows.groupBy(*keys).agg(fits.cast("long").alias("word_count"))


def _sum_up(found: DataFrame, windows: range | None, keys: tuple[str, ...]) -> DataFrame:
    """Sum of ``counted`` per window_size and ``keys``.

    Words that stand together do so at several distances, the more often the
    more text there is. So with known ``windows`` the sums for all window sizes
    are kept in one row per pair of words, and only such rows are shuffled.
    """
    if windows is None or len(windows) > MAX_SUMS:
        size = F.col("window_size")
        if windows is not None:
            size = _within(windows).alias("window_size")
        return found.groupBy(size, *keys).agg(F.sum("counted").alias("word_count"))
    size = _within(windows)
    sums = [
        F.sum(F.when(size == k, F.col("counted")).otherwise(0)).alias(f"sum_{k}") for k in windows
    ]
    by_window = F.array(
        *(
            F.struct(F.lit(k).alias("window_size"), F.col(f"sum_{k}").alias("word_count"))
            for k in windows
        )
    )
    # One string holds both words, invertibly: rows of the shuffle are a fifth smaller.
    sizes = F.char_length("word1").cast("string")
    others = [k for k in keys if k not in ("word1", "word2")]
    both = F.concat(sizes, F.lit(":"), "word1", "word2").alias("_pair")
    begin = F.instr("_pair", ":") + 1
    length = F.substring_index("_pair", ":", 1).cast("int")
    summed = found.groupBy(both, *others).agg(*sums)
    rows = summed.select(
        F.substr("_pair", begin, length).alias("word1"),
        F.substr("_pair", begin + length).alias("word2"),
        *others,
        F.inline(by_window),
    )
    return rows.where(F.col("word_count") > 0).select("window_size", *keys, "word_count")


def _within(windows: range) -> Column:
    """The window size, or an error if it is not one of those that were announced."""
    size = F.col("window_size")
    wrong = F.concat(F.lit("unexpected window size "), size.cast("string"))
    inside = size.between(windows[0], windows[-1]) & ((size - windows[0]) % windows.step == 0)
    return F.when(inside, size).otherwise(F.raise_error(wrong).cast("int"))


def literal_overflow(literal: DataFrame) -> DataFrame:
    """Counts of literal mode beyond 32 bits: window_size, word, n, units.

    ``n`` is the number of occurrences in a unit, ``units`` the number of units
    that have so many. ``literal`` are the rows of literal mode, which hold these
    counts like any other.
    """
    return literal.where(F.col("doublings") > FITS_32_BITS).select(
        "window_size",
        F.col("word1").alias("word"),
        (F.col("doublings") + 1).cast("long").alias("n"),
        F.col("word_count").alias("units"),
    )


def _literal_per_unit(pairs: DataFrame, keys: tuple[str, ...], copies: str | None) -> DataFrame:
    """Per unit and unordered pair: n, turns, and the last orientation.

    One sort by (unit, window, pair, position) serves the three window
    expressions; the last row of a group carries its totals.
    """
    group = (*keys, "window_size", "low", "high")
    flat = pairs.select(
        *keys,
        "window_size",
        "pos",
        F.least("a", "b").alias("low"),
        F.greatest("a", "b").alias("high"),
        (F.col("a") <= F.col("b")).alias("forward"),
        (F.lit(1) if copies is None else F.col(copies)).cast("long").alias("copies"),
    )
    in_order = Window.partitionBy(*group).orderBy("pos")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turned = F.col("forward") != F.lag("forward").over(in_order)
    totals = (
        flat.withColumn("turn", F.coalesce(turned.cast("int"), F.lit(0)))
        .withColumn("n", F.row_number().over(in_order))
        .withColumn("turns", F.sum("turn").over(so_far))
        .withColumn("is_last", F.lead("pos").over(in_order).isNull())
        .where("is_last")
    )
    return totals.select(
        "window_size",
        F.when(F.col("forward"), F.col("low")).otherwise(F.col("high")).alias("word1"),
        F.when(F.col("forward"), F.col("high")).otherwise(F.col("low")).alias("word2"),
        "n",
        "turns",
        "copies",
    )
