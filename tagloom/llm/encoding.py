"""Token ids by the tokenizers library, each distinct word encoded once."""

from __future__ import annotations

import ctypes
import json
import os
import re
import sys
from collections.abc import Iterable, Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A space before a visible ASCII character, a letter or a digit always begins a new piece of
# the byte-level pattern, whatever stands before it; so does one of these marks after letters.
_CUT = re.compile(r" (?=[!-~\w])")
_UNCUT = r" ([^!-~\pL\pN]|$)"
_MARKS = ".,;:!?|#$%&*)\n"
_LETTERS = re.compile(rf"[^\W\d_]+(?=[{_MARKS}])")

#: Distinct words that a worker process keeps before it lets go of those not met lately.
CACHED_WORDS = 250_000
#: Characters of text encoded together.
_AT_ONCE = 6_000_000


class Kept:
    """A dictionary that forgets what was not asked for while ``limit`` others came in."""

    def __init__(self, limit: int):
        self.limit, self.new, self.old = limit, {}, {}

    def lacks(self, keys: Iterable[str]) -> list[str]:
        """The different keys that are not known; the others are in ``new`` from now on."""
        new, old, missing = self.new, self.old, {}
        for k in keys:
            if k not in new:
                if k in old:
                    new[k] = old[k]
                else:
                    missing[k] = None
        return list(missing)

    def turn(self) -> None:
        if len(self.new) > self.limit:
            self.old, self.new = self.new, {}


def give_back() -> None:
    """Return memory that a task has freed to the system; idle workers stay for a while."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


class Encoder:
    """``encode_batch(texts, add_special_tokens=False)``, faster for byte-level vocabularies.

    Their pattern never joins what stands before and after a space that begins a
    word, or letters and the punctuation behind them. So texts are cut there and
    each distinct word goes through the library once. Other vocabularies, and
    texts that hold a special token, go through it whole. Texts may be of any
    length. ``words`` distinct words are kept, and ``characters`` of text encoded
    together: more is faster and needs more memory.
    """

    def __init__(self, path: str, words: int = CACHED_WORDS, characters: int = _AT_ONCE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        parts = json.loads(self.tokenizer.to_str())
        before = parts["pre_tokenizer"] or {}
        self.by_word = (
            parts["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
        )
        self.heads = Kept(words)  # letters that follow a space
        self.others = Kept(words)  # what follows no space
        self.characters = characters

    @classmethod
    def of(cls, *args: str | int) -> Encoder:
        """The one that this worker process has, with the words it knows from earlier tasks."""
        kept = sys.modules.setdefault("_tagloom_worker", SimpleNamespace(encoders={}))
        if args not in kept.encoders:
            kept.encoders[args] = cls(*args)
        return kept.encoders[args]

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _learn_heads(self, heads: list[str]) -> None:
        """Words of letters alone go in one call: each begins where a token holds a space."""
        for at in range(0, len(heads), 10_000):
            some = heads[at : at + 10_000]
            data = self._library([" " + " ".join(some)])[0]
            starts = (np.flatnonzero(self.begins[np.frombuffer(data, "<u4")]) * 4).tolist()
            ids = [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)], strict=True)]
            self.heads.new.update(zip(some, ids, strict=True))

    def _other(self, pieces: list[str]) -> list[bytes]:
        new = self.others.lacks(pieces)
        self.others.new.update(zip(new, self._library(new), strict=True))
        return [self.others.new[p] for p in pieces]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words that follow a space."""
        known = self.heads.new
        ids = list(map(known.get, words))
        # Letters alone, letters with what follows them (place, letters, rest), and all else.
        plain, at, heads, rests, odd = [], [], [], [], []
        for i in [i for i, found in enumerate(ids) if found is None]:
            w = words[i]
            if (head := w[:-1]).isalpha() and (mark := w[-1]) in _MARKS:
                at.append(i)
                heads.append(head)
                rests.append(mark)
            elif w.isalpha():
                plain.append(i)
            elif f := _LETTERS.match(w):
                at.append(i)
                heads.append(f[0])
                rests.append(w[f.end() :])
            else:
                odd.append(i)
        alone = [words[i] for i in plain]
        self._learn_heads(self.heads.lacks(alone + heads))
        for i, w in zip(plain, alone, strict=True):
            ids[i] = known[w]
        for i, head, rest in zip(at, heads, self._other(rests), strict=True):
            ids[i] = known[head] + rest
        for i, found in zip(odd, self._other([f" {words[i]}" for i in odd]), strict=True):
            ids[i] = found
        return ids

    def _cut(self, pieces: pa.ListArray) -> list[np.ndarray]:
        """Ids of texts, each given as what was before and between its cuts."""
        offsets = pieces.offsets.to_numpy()
        flat = pieces.values
        words = flat.dictionary_encode()
        which = words.indices.to_numpy().astype(np.int64)
        distinct = words.dictionary.to_pylist()
        firsts = [distinct[i] for i in which[offsets[:-1]]]
        ids = self._words(distinct) + self._other(firsts)
        which[offsets[:-1]] = len(distinct) + np.arange(len(firsts))
        self.heads.turn()
        self.others.turn()

        every = np.frombuffer(b"".join(ids), "<u4")
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        begin = np.cumsum(length) - length
        tokens = length[which]
        end = np.cumsum(tokens)
        # Batches are bounded, so places fit 32 bits unless one text is huge.
        small = np.int32 if max(len(every), int(end[-1])) < 2**31 else np.int64
        place = np.repeat((begin[which] - (end - tokens)).astype(small), tokens)
        place += np.arange(len(place), dtype=small)
        out = every[place]
        cuts = np.concatenate(([0], end))[offsets].tolist()
        return [out[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        array = pa.array(texts, pa.string())
        uncut = pc.match_substring_regex(array, _UNCUT).to_numpy(zero_copy_only=False)
        out: list = [None] * len(texts)
        for mixed in (False, True):
            at = np.flatnonzero(uncut == mixed)
            if len(at):
                some = array.take(pa.array(at))
                pieces = (
                    pa.array([_CUT.split(t) for t in some.to_pylist()], pa.list_(pa.string()))
                    if mixed
                    else pc.split_pattern(some, " ")
                )
                for i, ids in zip(at.tolist(), self._cut(pieces), strict=True):
                    out[i] = ids
        return out

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text in order, as unsigned 32-bit integers; null is empty."""
        waiting: list[str] = []
        size = 0
        for text in texts:
            text = text or ""
            if not self.by_word or any(s in text for s in self.special):
                yield from self._encode(waiting)
                waiting, size = [], 0
                yield np.frombuffer(self._library([text])[0], "<u4")
            else:
                waiting.append(text)
                size += len(text)
                if size >= self.characters:
                    yield from self._encode(waiting)
                    waiting, size = [], 0
        yield from self._encode(waiting)
