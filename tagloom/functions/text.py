"""Column functions on post text: cleaning and tokenising.

All of them stay inside the JVM (no Python per row) and can be used in any
``select`` or ``where``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cleaning rules, in the order in which they apply.
# WHITESPACE spells out Unicode whitespace, because Java's \s is ASCII only.
WHITESPACE = r"\s\p{Z}\x1c-\x1f\x85"
URL = rf"http[^{WHITESPACE}]+|www[^{WHITESPACE}]+|https[^{WHITESPACE}]+"
SPECIAL = rf"[^A-Za-zåäöÅÄÖ{WHITESPACE}]"
DIGITS = r"\p{Nd}+"
SPACES = rf"[{WHITESPACE}]+"


def _column(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


def clean_text(
    text: Column | str,
    remove_urls: bool = True,
    remove_special_chars: bool = True,
    remove_digits: bool = True,
) -> Column:
    """Lower-case, drop URLs, special characters and digits, collapse whitespace."""
    out = F.lower(_column(text))
    if remove_urls:
        # A plain search first: most texts need no pattern matching.
        has_url = out.contains("http") | out.contains("www")
        out = F.when(has_url, F.regexp_replace(out, URL, "")).otherwise(out)
    if remove_special_chars:
        out = F.regexp_replace(out, SPECIAL, "")
    # Without special characters there is no digit left to remove.
    elif remove_digits:
        out = F.regexp_replace(out, DIGITS, "")
    return F.trim(F.regexp_replace(out, SPACES, " "))


def tokens(text: Column | str) -> Column:
    """Words of a text, split on whitespace, without empty words."""
    return F.array_remove(F.split(_column(text), SPACES), "")


def words(text: Column | str, **flags: bool) -> Column:
    """Words of a text after cleaning (which leaves single spaces only)."""
    return F.array_remove(F.split(clean_text(text, **flags), " "), "")
