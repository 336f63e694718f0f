"""Numbers of tokens by byte-pair merging with a heap and a linked list.

A piece of text starts as its bytes' symbols, each linked to its neighbours. A
heap holds the adjacent pairs that may merge, by rank and place; the lowest is
popped again and again and its pair merged, and the pairs that this makes are
pushed. A piece has as many tokens as symbols at first, less the merges: no ids
are made. The merges come from the vocabulary's file; the tokenizers library is
not used.
"""

from __future__ import annotations

import heapq
import json
import sys
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import lean_batches, text_or_empty
from tagloom.llm.encoding import _CUT, _UNCUT, Kept

LIMIT = 1024
#: Distinct words whose counts a worker process keeps.
CACHED_WORDS = 500_000
_AT_ONCE = 12_000_000

# How byte-level vocabularies split a text into pieces.
_PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+", regex.V1
)


def _byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if it is visible, else one after U+00FF."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


class Counter:
    """Counts tokens as a byte-level byte-pair vocabulary of the given file gives them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, before = data["model"], data["pre_tokenizer"] or {}
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or data["normalizer"] is not None:
            raise ValueError(f"{path} holds no byte-level byte-pair vocabulary")
        ids = model["vocab"]
        self.byte_ids = [ids[c] for c in _byte_symbols()]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # pair -> rank and what it becomes
        self.merges = {
            ids[a] << 32 | ids[b]: (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)
        }
        special = sorted((t["content"] for t in data["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.words = Kept(CACHED_WORDS)  # what follows a space
        self.pieces = Kept(CACHED_WORDS)

    @classmethod
    def of(cls, path: str) -> Counter:
        """The one that this worker process has, with the words it knows from earlier tasks."""
        kept = sys.modules.setdefault("_tagloom_counters", SimpleNamespace(counters={}))
        if path not in kept.counters:
            kept.counters[path] = cls(path)
        return kept.counters[path]

    def count_piece(self, piece: str) -> int:
        """Symbols of one piece at first, less the merges."""
        byte_ids, merges = self.byte_ids, self.merges
        symbols = [byte_ids[b] for b in piece.encode("utf-8", "replace")]
        n = left = len(symbols)
        heap = []
        for i in range(n - 1):
            merge = merges.get(symbols[i] << 32 | symbols[i + 1])
            if merge is not None:
                heap.append((merge[0], i, merge[1]))
        if not heap:
            return left
        heapq.heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while heap:
            rank, i, merged = heapq.heappop(heap)
            j = after[i]
            # The pair may be gone: its left symbol merged away (-1) or either one changed.
            if symbols[i] < 0 or j >= n or merges.get(symbols[i] << 32 | symbols[j], (None,))[0] != rank:
                continue
            symbols[i], symbols[j] = merged, -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                merge = merges.get(merged << 32 | symbols[k])
                if merge is not None:
                    heapq.heappush(heap, (merge[0], i, merge[1]))
            h = before[i]
            if h >= 0:
                merge = merges.get(symbols[h] << 32 | merged)
                if merge is not None:
                    heapq.heappush(heap, (merge[0], h, merge[1]))
        return left

    def _of_pieces(self, pieces: list[str]) -> list[int]:
        for p in self.pieces.lacks(pieces):
            self.pieces.new[p] = self.count_piece(p)
        return [self.pieces.new[p] for p in pieces]

    def _words(self, words: list[str]) -> list[int]:
        """Counts of words that follow a space."""
        new = self.words.lacks(words)
        simple = [w for w in new if w.isalpha()]
        self.words.new.update(zip(simple, [self.count_piece(f" {w}") for w in simple], strict=True))
        for w in new:
            if w not in self.words.new:
                self.words.new[w] = sum(self._of_pieces(_PIECES.findall(f" {w}")))
        return [self.words.new[w] for w in words]

    def count_whole(self, text: str) -> int:
        """Tokens of one text that is not cut; special strings count as one each."""
        parts = self.special.split(text) if self.special else [text]
        pieces = [p for part in parts for p in _PIECES.findall(part)]
        return len(parts) - 1 + sum(self._of_pieces(pieces))

    def _cut(self, texts: pa.Array) -> list[int]:
        """Counts of texts in which a word follows every space."""
        pieces = pc.split_pattern(texts, " ")
        offsets = pieces.offsets.to_numpy()
        words = pieces.values.dictionary_encode()
        which = words.indices.to_numpy()
        distinct = words.dictionary.to_pylist()
        count = np.array(self._words(distinct), np.int64)[which]
        firsts = [distinct[i] for i in which[offsets[:-1]]]
        count[offsets[:-1]] = [self.count_whole(f) for f in firsts]
        total = np.concatenate(([0], np.cumsum(count)))[offsets]
        return np.diff(total).tolist()

    def count(self, texts: list[str | None]) -> list[int]:
        """Numbers of tokens of texts; null has none."""
        texts = [t or "" for t in texts]
        uncut = pc.match_substring_regex(pa.array(texts, pa.string()), _UNCUT).to_pylist()
        out = [0] * len(texts)
        waiting, size = [], 0
        for i, text in enumerate(texts):
            if self.special and self.special.search(text):
                out[i] = self.count_whole(text)
            elif uncut[i]:
                first, *words = _CUT.split(text)
                out[i] = self.count_whole(first) + sum(self._words(words))
            else:
                waiting.append(i)
                size += len(text)
            if waiting and (size >= _AT_ONCE or i == len(texts) - 1):
                found = self._cut(pa.array([texts[k] for k in waiting], pa.string()))
                for k, n in zip(waiting, found, strict=True):
                    out[k] = n
                waiting, size = [], 0
        for kept in (self.words, self.pieces):
            kept.turn()
        return out


def count_tokens(text: Column, tokenizer: str) -> Column:
    """Number of tokens of a text by the byte-level vocabulary of the file ``tokenizer``."""

    @F.pandas_udf("long")
    def counted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter.of(tokenizer)
        for some in texts:
            yield pd.Series(counter.count(some.tolist()), dtype="int64")

    return counted(text)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: a row per row of ``docs``.

    Null and empty texts have no bytes and no tokens. Rows are independent of
    each other, so repeated rows and ids give repeated rows.
    """
    lean_batches(docs.sparkSession)
    return docs.select(
        "doc_id",
        F.octet_length(text_or_empty()).cast("long").alias("n_bytes"),
        count_tokens(text_or_empty(), tokenizer).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
