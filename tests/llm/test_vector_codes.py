import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from tagloom.llm.vector_codes import digest, nearest, train_codes


def brute_nearest(points, book):
    out = []
    for x in points.tolist():
        dists = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in book.tolist()]
        best = min(dists)
        out.append((dists.index(best), best))
    return out


def test_equal_average_search_equals_brute_force():
    rng = np.random.default_rng(3)
    for width, k, spread in ((4, 64, 5), (4, 7, 2), (1, 64, 3), (8, 3, 100)):
        book = rng.integers(-spread, spread + 1, (k, width))
        book[k // 2] = book[0]  # equal entries: the lower index wins
        points = rng.integers(-spread - 2, spread + 3, (500, width))
        index, dist = nearest(points, book)
        assert list(zip(index.tolist(), dist.tolist())) == brute_nearest(points, book)


def brute_codes(rows, entries=64, rounds=2, parts=16):
    """Plain Python k-means over integer parts, as the contract reads."""
    kept = [(i, l, [math.floor(256 * x) for x in v]) for i, l, v in rows
            if v is not None and len(v) and len(v) % parts == 0 and all(x is not None and math.isfinite(x) and abs(x) < 4096 for x in v)]
    if not kept:
        return [], None
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    d = len(min(kept, key=key)[2])
    kept = [r for r in kept if len(r[2]) == d]
    w = d // parts
    first = sorted(kept, key=key)[:entries]
    books = [[r[2][p * w : (p + 1) * w] for r in first] for p in range(parts)]

    def assign(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(v[p * w : (p + 1) * w], c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        sums = {}
        for _, _, v in kept:
            for p in range(parts):
                e = assign(v, p)[1]
                s, n = sums.get((p, e), ([0] * w, 0))
                sums[(p, e)] = ([a + b for a, b in zip(s, v[p * w : (p + 1) * w])], n + 1)
        for (p, e), (s, n) in sums.items():
            books[p][e] = [a // n for a in s]
    out = []
    for i, l, v in kept:
        found = [assign(v, p) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(dd for dd, _ in found)))
    flat = ",".join(str(x) for book in books for entry in book for x in entry)
    return sorted(out, key=repr), hashlib.sha256(flat.encode()).hexdigest()


def vectors(n, seed, dim=64):
    rng = np.random.default_rng(seed)
    return rng.normal(0, 0.2, (n, dim)).astype(np.float32).tolist()


def test_against_brute_force_with_edge_rows(spark):
    rows = [(i, i % 3, v) for i, v in enumerate(vectors(150, 1))]
    rows += [
        (200, None, None),  # null vector
        (201, 1, [float("nan")] * 64),
        (202, 1, [1.0] * 63 + [float("inf")]),
        (203, 2, [0.1] * 63 + [None]),
        (204, None, [0.5] * 32),  # another width
        (None, 2, vectors(1, 9)[0]),  # null id: last
        (5, 0, rows[5][2]),  # repeated row
        (7, 1, vectors(1, 8)[0]),  # repeated id, other vector
    ]
    docs = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    docs = docs.withColumn("code", F.lit("clash")).withColumn("_row", F.lit(1)).repartition(3)
    coded, books = train_codes(docs)
    got = sorted(map(tuple, coded.select("vec_id", "code", "error").collect()), key=repr)
    want, sha = brute_codes([(i, l, v) for i, l, v in rows])
    assert got == want
    assert digest(books) == sha
    assert len(got) == 150 + 3


def test_few_rows_and_empty(spark):
    rows = [(i, 0, v) for i, v in enumerate(vectors(5, 2, 32))]
    docs = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    coded, books = train_codes(docs)
    assert books.shape == (16, 5, 2)
    assert sorted(map(tuple, coded.select("vec_id", "code", "error").collect())) == brute_codes(rows)[0]
    coded, books = train_codes(docs.limit(0))
    assert coded.count() == 0 and books.size == 0
    nothing = spark.createDataFrame([(1, 0, None)], "vec_id long, label int, embedding array<float>")
    assert train_codes(nothing)[0].count() == 0
