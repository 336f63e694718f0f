"""Quality rules in a bitmask ledger.

Measurements of a text are taken once. Each rule is evaluated once over them and
its failures become bits of one number, stored with the measurements. Policies
are versions of "which rules count": applying one, or asking what a policy would
keep without one of its rules, only touches the bits.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import lean_batches

SPACES = " \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(0x41, 0x5B))
LETTERS = UPPER + bytes(range(0x61, 0x7B))
MARKS = bytes(b for b in range(0x21, 0x7F) if b not in LETTERS)  # visible ASCII but letters
SPAN = 5

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_letters",
    "n_marks",
)

#: What fails, by the place of its bit. Integers only, so that any engine gives the same.
RULES = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 25 * n_words",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars < 3 * n_words OR word_chars > 12 * n_words",
    "upper_case": "n_letters >= 40 AND 2 * n_upper > n_letters",
    "marks": "100 * n_marks > 40 * word_chars",
}

BASE = ("few_words", "repeated_words")

#: Versions are never changed, only added.
POLICIES = {"v1": BASE, "v2": tuple(RULES)}
POLICY = "v2"


def _repeated_words(words: list[bytes]) -> int:
    """Words in windows of ``SPAN`` words that occur twice or more, each word once."""
    n = len(words)
    if n <= SPAN:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, n)
    if len(number) == n:
        return 0
    windows = n - SPAN + 1
    # Different hashes mean different windows; only texts with equal ones need the exact numbering.
    factor = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        hashed = functools.reduce(lambda h, i: h * factor + ids[i : i + windows], range(SPAN), np.zeros(windows, np.uint64))
    if len(np.unique(hashed)) == windows:
        return 0
    exact = ids[:windows]
    for i in range(1, SPAN):
        exact = np.unique(exact * np.uint64(len(number)) + ids[i : i + windows], return_inverse=True)[1].astype(np.uint64)
    numbers = exact.astype(np.int64)
    twice = np.bincount(numbers)[numbers] > 1
    edges = np.zeros(n + 1, np.int64)
    edges[:windows] += twice
    edges[SPAN : SPAN + windows] -= twice
    return int(np.count_nonzero(np.cumsum(edges[:n])))


def _measure(text: str | None) -> tuple[int, ...]:
    text = text or ""
    data = text.encode("utf-8", "replace")
    words = data.split()  # ASCII white space
    lines = [line for line in data.split(b"\n") if line.strip()]
    size = len(data)
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        size - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated_words(words),
        len(lines),
        size - len(data.translate(None, UPPER)),
        size - len(data.translate(None, LETTERS)),
        size - len(data.translate(None, MARKS)),
    )


def measures(text: Column) -> Column:
    """A struct of ``MEASURES`` of a text; null counts as empty."""

    @F.pandas_udf(", ".join(f"{m} long" for m in MEASURES))
    def measured(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_measure(t) for t in texts], columns=list(MEASURES), dtype="int64")

    return measured(text)


def mask(rules: tuple[str, ...]) -> int:
    return sum(1 << list(RULES).index(r) for r in rules)


def fail_bits(measured: str) -> Column:
    """The bits of the rules that the measurements in the struct column ``measured`` fail."""
    bits = F.lit(0).cast("long")
    for place, rule in enumerate(RULES.values()):
        fails = F.expr(re.sub(r"[a-z]\w+", lambda name: f"{measured}.{name[0]}", rule))
        bits = bits.bitwiseOR(F.when(fails, F.lit(1 << place)).otherwise(F.lit(0)).cast("long"))
    return bits


def passes(bits: str | Column, rules: tuple[str, ...]) -> Column:
    """Whether no rule of a policy failed."""
    bits = F.col(bits) if isinstance(bits, str) else bits
    return bits.bitwiseAND(F.lit(mask(rules)).cast("long")) == 0


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, ``MEASURES``, fail_bits: a row per row of ``docs``.

    ``docs`` needs doc_id and text; other columns are ignored. Null and empty
    texts have no words and fail ``few_words`` only. Rows are independent of each
    other, so repeated rows and ids give repeated rows, and an empty table an
    empty one.
    """
    lean_batches(docs.sparkSession)
    measured = docs.select("doc_id", measures(F.col("text")).alias("m"))
    return measured.select("doc_id", "m.*", fail_bits("m").alias("fail_bits"))


def ablations(rows: DataFrame, policies: Mapping[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """policy, rule, n_failed, n_only: what each rule rejects, and what it alone rejects.

    ``rows`` come from :func:`ledger`. They are counted by their bits first (at
    most a row per subset of the rules); policies and rules meet those counts.
    """
    counts = rows.groupBy("fail_bits").count()
    tested = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(policy).alias("policy"),
                    F.lit(rule).alias("rule"),
                    F.lit(mask(rules)).cast("long").alias("policy_mask"),
                    F.lit(mask((rule,))).cast("long").alias("rule_mask"),
                )
                for policy, rules in policies.items()
                for rule in rules
            )
        )
    )
    failed = F.col("fail_bits").bitwiseAND(F.col("t.policy_mask"))
    return (
        counts.withColumn("t", tested)
        .groupBy("t.policy", "t.rule")
        .agg(
            F.sum(F.when(failed.bitwiseAND(F.col("t.rule_mask")) != 0, F.col("count")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(failed == F.col("t.rule_mask"), F.col("count")).otherwise(0)).alias("n_only"),
        )
    )


def judged(docs: DataFrame, policy: str = POLICY) -> DataFrame:
    """The ledger with base_failed and kept, the verdict of a policy."""
    return ledger(docs).select(
        "*",
        (~passes("fail_bits", BASE)).alias("base_failed"),
        (passes("fail_bits", BASE) & passes("fail_bits", POLICIES[policy])).alias("kept"),
    )


def keep_good(docs: DataFrame, policy: str = POLICY) -> DataFrame:
    """The rows of ``docs`` that a policy keeps, columns as they were; nothing is shuffled."""
    lean_batches(docs.sparkSession)
    measured = docs.select(F.struct("*").alias("_all"), measures(F.col("text")).alias("_measures"))
    rules = (*BASE, *POLICIES[policy])
    return measured.where(passes(fail_bits("_measures"), tuple(dict.fromkeys(rules)))).select("_all.*")
