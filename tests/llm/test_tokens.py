"""Encoding, counting, packing and files of token ids against the tokenizers library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tagloom.llm import id_files, packing
from tagloom.llm.encoding import Encoder, Kept
from tagloom.llm.id_files import Segment, id_files as ids_of, segments, write_segment
from tagloom.llm.packing import Windows, pack
from tagloom.llm.token_counts import Counter, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "B", " ", "  ", "\n", "\t", "é", "<|endoftext|>", "'s", "1", "!", " ", "\x1c", "\x85", "᠎", "字", "_",
         " x", "​", "﻿", "́", "😀", "<|", "'", ".", "|", "the", "ing", " the", "don't"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def fuzz(n):
    rng = random.Random(7)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_encoder(library, edge_rows):
    texts = fuzz(20_000) + [t for _, t, *_ in edge_rows]
    found = Encoder(PATH).encode(texts)
    for got, want in zip(found, library.encode_batch([t or "" for t in texts], add_special_tokens=False), strict=True):
        assert got.tolist() == want.ids


def test_encoder_of_another_kind(edge_rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [t or "" for _, t, *_ in edge_rows]
    want = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert [g.tolist() for g in Encoder(path).encode(texts)] == [w.ids for w in want]


def test_kept_forgets():
    kept = Kept(2)
    for keys in ("abc", "ad", "e", "a"):
        kept.new.update((k, k) for k in kept.lacks(keys))
        assert all(kept.new[k] == k for k in keys)
        kept.turn()
    assert "b" in kept.lacks("ab")


def test_counter(library, edge_rows):
    texts = fuzz(20_000) + [t for _, t, *_ in edge_rows] + ["ab" * 3000]
    want = [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert Counter(PATH).count(texts) == want
    with pytest.raises(ValueError):
        Counter(public_tokenizers.path("word_bpe_49k.json"))


def test_token_counts(edge, edge_rows, empty, library, rows):
    want = []
    for doc, text, *_ in edge_rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((doc, len((text or "").encode()), n, n > 1024))
    assert rows(token_counts(edge, PATH)) == sorted(want, key=repr)
    assert token_counts(empty, PATH).count() == 0


def test_segments():
    rng = np.random.default_rng(2)
    for n in (0, 1, 255, 256, 257, 5000):
        for top in (1, 2, 300, 50257, 2**32):
            ids = rng.integers(0, top, n, dtype=np.uint64).astype("<u4")
            if n > 10 and top == 300:
                ids[7] = 4_000_000_000  # an outlier
            docs = [(None, ids), (5, np.array([9], "<u4"))]
            content = (write_segment(3, 0, docs) + b"\n") + (write_segment(3, 1, docs) + b"\n")
            found = list(segments(content))
            assert [s.number for s in found] == [0, 1]
            for s in found:
                assert s.read(0, n + 1).tolist() == [*ids.tolist(), 9]
                assert s.nulls.tolist() == [1, 0] and s.lengths.tolist() == [n, 1]
                for start in range(0, n, 701):
                    assert s.read(start, 13).tolist() == [*ids.tolist(), 9][start : start + 13]


def test_outliers_do_not_widen_blocks():
    ids = np.arange(256, dtype="<u4") % 16
    plain = len(write_segment(0, 0, [(1, ids)]))
    ids[3] = 50_000
    assert len(write_segment(0, 0, [(1, ids)])) == plain + 6
    with pytest.raises(ValueError):
        Segment(b"X" + write_segment(0, 0, [(1, ids)])[1:])


def test_id_files(edge, edge_rows, empty, library, monkeypatch):
    monkeypatch.setattr(id_files, "SEGMENT", 1000)
    want, start = {}, 0
    ordered = sorted(edge_rows, key=lambda r: -1 if r[0] is None else r[0])
    for doc, text, *_ in ordered:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        want.setdefault(doc, []).append((start, len(ids), crc(ids)))
        start += len(ids)
    found = defaultdict(list)
    for r in ids_of(edge, PATH).collect():
        found[r.doc_id].append((r.start, r.n_tokens, r.ids_crc32))
    assert {d: sorted(v) for d, v in found.items()} == want
    assert ids_of(empty, PATH).count() == 0


def check_pieces(pieces, docs, library, window=1024, end=0):
    """Every id of every document in one piece, windows without gaps and (but for few) full."""
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_window[p.sequence_id].append(p)
    want = defaultdict(list)
    for doc, text in docs:
        want[doc].append([*library.encode(text or "", add_special_tokens=False).ids, end])
    assert set(want) == set(by_doc)
    for doc, copies in want.items():
        left = [(p.start, p.length, p.ids_crc32, p.doc_tokens) for p in by_doc[doc]]
        for ids in copies:
            at = 0
            while at < len(ids):
                fits = [x for x in left if x[0] == at and x[3] == len(ids) and x[2] == crc(ids[at : at + x[1]])]
                left.remove(fits[0])
                at += fits[0][1]
        assert not left
    assert sorted(by_window) == list(range(len(by_window)))
    short = 0
    for some in by_window.values():
        at = 0
        for p in sorted(some, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        short += at < window
    return short


def test_pack(edge, edge_rows, empty, library):
    docs = [(d, t) for d, t, *_ in edge_rows]
    assert check_pieces(pack(edge, PATH).collect(), docs, library) <= edge.rdd.getNumPartitions()
    assert pack(empty, PATH).count() == 0


def test_pack_documents(spark, small, library):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert check_pieces(pack(docs, PATH).collect(), texts, library) <= 1


def test_levels():
    """The chosen level makes the sum of squares smallest, as tried out one by one."""
    rng = random.Random(3)
    windows = Windows(32)
    for i in range(400):
        length = rng.randint(1, 31)
        sums = {}
        for level in range(32 - length + 1):
            if level == 0 or windows.count[level]:
                after = windows.count.copy()
                if level:
                    after[level] -= 1
                if level + length < 32:
                    after[level + length] += 1
                sums[level] = int((after**2).sum())
        chosen = windows.level_for(length)
        assert chosen == max(h for h, s in sums.items() if s == min(sums.values()))
        windows.put((i, length, 0, np.zeros(length, "<u4")))
        assert [len(w) for w in windows.open] == windows.count[:32].tolist()
    assert packing.WINDOW == 1024
