import hashlib
import random

import numpy as np
import pytest

from tagloom.llm import repeats
from tagloom.llm.repeats import core_size, names, remove_repeats, units


def expected(rows, threshold=100):
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        data = (text or "").encode()
        gone, starts = bytearray(len(data)), range(len(data) - threshold + 1)
        for p in starts:
            string = data[p : p + threshold]
            if string in seen:
                gone[p : p + threshold] = b"\1" * threshold
            seen.add(string)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1]))
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def compared(docs, threshold=100):
    found = remove_repeats(docs, threshold).collect()
    for r in found:
        assert sum(s.end - s.begin for s in r.spans) == r.n_removed and len(r.spans) == r.n_spans
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found), key=repr)


def texts(seed, n, alphabet="abcdefgh ", shared=4):
    rng = random.Random(seed)

    def some(k):
        return "".join(rng.choice(alphabet) for _ in range(k))

    passages = [some(rng.choice((60, 99, 100, 101, 130, 300, 700))) for _ in range(shared)]
    rows = []
    for doc in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.5 else some(rng.randint(0, 250)) for _ in range(rng.randint(0, 6))]
        rows.append((doc, "".join(parts)))
    rows += [(n, "x" * 450), (n + 1, "x" * 99), (n + 2, "y" * 100), (n + 3, ("ab" * 80) + "c")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("threshold", [100, 17, 256])
def test_random_texts(spark, threshold):
    rows = texts(threshold, 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert compared(docs, threshold) == expected(rows, threshold)


def test_two_letters(spark):
    rows = texts(5, 25, alphabet="ab", shared=2)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert compared(docs) == expected(rows)


def test_slices_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_TOGETHER", 333)
    rows = texts(6, 30)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert compared(docs) == expected(rows)


def test_edge_rows(edge, edge_rows, empty):
    assert compared(edge) == expected([(d, t) for d, t, *_ in edge_rows])
    assert remove_repeats(empty).count() == 0


def test_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert compared(docs) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_hot_passage(spark):
    from pyspark.sql import functions as F

    passage = "the same passage in every text, " * 5
    docs = spark.range(0, 400, 1, 8).select(
        F.col("id").alias("doc_id"),
        F.concat(F.col("id").cast("string"), F.lit(passage), F.sha2(F.col("id").cast("string"), 512)).alias("text"),
    )
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert compared(docs) == expected(rows)


def test_names_double():
    data = np.frombuffer(b"abracadabra abracadabra", np.uint8)
    for size in (1, 2, 4, 8):
        name = names(data, size)
        assert len(name) == len(data) - size + 1
        strings = [bytes(data[i : i + size]) for i in range(len(name))]
        assert len(set(strings)) == len(set(name.tolist()))
        assert all((name[i] == name[j]) == (strings[i] == strings[j]) for i in range(len(name)) for j in range(i))
    assert [core_size(t) for t in (17, 64, 100, 127, 128)] == [8, 32, 32, 32, 64]


def test_units_cover_all_windows():
    data = np.frombuffer(random.Random(1).randbytes(3000), np.uint8)
    begin, windows, _, _ = units(data, np.array([1200, 1250, 3000]), 100)
    covered = [b + i for b, n in zip(begin.tolist(), windows.tolist(), strict=True) for i in range(n)]
    assert covered == [*range(1101), *range(1250, 2901)]
    assert len(begin) < len(covered) / 20
