"""From posts to rows of the word pair table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.literal import canonical_sums, literal_sums
from tagloom.operators.pairs import count_pairs, endpoint_pairs
from tagloom.operators.sizes import stored_bytes
from tagloom.operators.units import (
    UNIT_KEYS,
    distinct_units,
    keyed_units,
    lemmatise,
    units,
    with_words,
)
from tagloom.schemas import MAX_WINDOW, MIN_WINDOW
from tagloom.sources.tables import batch_text

BLOCK_BYTES = 8 << 20  # of stored input from which sums are shuffled in packed blocks
WIDEST = (1 << 15) - 1  # window that a block can name


def unit_words(
    texts: DataFrame,
    lexicon: DataFrame | None = None,
    unit: str = "record",
    keyed: bool = False,
    combine: bool = False,
) -> DataFrame:
    """Units of ``text`` as words: [unit_hash, unit_no,] copies, words.

    Units that need no key are taken row by row, without a shuffle. ``combine``
    counts equal ones once instead, for a shuffle of all texts: worth it if most
    are copies. With a key or a lexicon equal units are always combined.
    """
    cut = units(texts, unit=unit)
    if not keyed and lexicon is None and not combine:
        return with_words(cut.select(F.lit(1).cast("long").alias("copies"), "text"))
    distinct = distinct_units(cut)
    if not keyed and lexicon is None:
        return with_words(distinct)
    spoken = with_words(keyed_units(distinct))
    if lexicon is None:
        return spoken
    return lemmatise(spoken, lexicon, keep=("copies",))


def unit_pairs(
    texts: DataFrame,
    lexicon: DataFrame | None = None,
    unit: str = "record",
    kmin: int = MIN_WINDOW,
    kmax: int = MAX_WINDOW,
    keyed: bool = False,
    combine: bool = False,
) -> DataFrame:
    """Window pairs of the units of ``texts``, with their copies (see :func:`unit_words`)."""
    keys = (*UNIT_KEYS, "copies") if keyed else ("copies",)
    return endpoint_pairs(unit_words(texts, lexicon, unit, keyed, combine), keys, kmin, kmax)


def word_pairs(
    tweets: DataFrame,
    batch: str | None = None,
    lexicon: DataFrame | None = None,
    unit: str = "record",
    kmin: int = MIN_WINDOW,
    kmax: int = MAX_WINDOW,
    mode: str = "canonical",
    combine: bool = False,
) -> DataFrame:
    """Word pair counts of one batch of posts (or of all): rows of ``wordpairs``.

    Pairs never cross posts. Literal mode has one more column, ``doublings``.
    There is a sum for nearly every pair, so a shuffle of sums is many times the
    input. From ``BLOCK_BYTES`` of stored input on, and in literal mode, they are
    counted and shuffled in packed blocks; a smaller input stays in generated code.
    """
    texts = batch_text(tweets, batch)
    if mode == "literal":
        return literal_sums(unit_words(texts, lexicon, unit, keyed=True), kmin, kmax)
    if kmax <= WIDEST and stored_bytes(texts) >= BLOCK_BYTES:
        return canonical_sums(unit_words(texts, lexicon, unit, combine=combine), kmin, kmax)
    pairs = unit_pairs(texts, lexicon, unit, kmin, kmax, combine=combine)
    return count_pairs(pairs, mode, windows=range(kmin, kmax + 1))
