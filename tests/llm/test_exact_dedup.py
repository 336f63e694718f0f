import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tagloom.llm.exact_dedup import drop_exact_duplicates, exact_dedup


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    groups = defaultdict(list)
    for doc, text, *_ in rows:
        groups[norm(text)].append(doc)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        stays = False
        for doc in ids:
            here = doc == keep and not stays
            stays |= here
            out.append((doc, keep, len(ids), here, sha))
    return sorted(out, key=repr)


def test_against_brute_force(edge, edge_rows, rows):
    assert rows(exact_dedup(edge)) == expected(edge_rows)


def test_weak_digest_gives_the_same(edge, edge_rows, rows):
    weak = exact_dedup(edge, digest=lambda text: (F.length(text) % 3).cast("string").cast("binary"))
    assert rows(weak) == expected(edge_rows)


def test_hot_group(spark, rows):
    docs = spark.range(0, 3000, 1, 8).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("same  text")).otherwise(F.col("id").cast("string")).alias("text")
    )
    found = exact_dedup(docs)
    assert found.where("group_size = 2000 AND keep_id = 1").count() == 2000
    assert found.where("kept").count() == 1001


def test_empty(empty):
    assert exact_dedup(empty).count() == 0


def test_dropping_keeps_columns(edge, edge_rows):
    kept = drop_exact_duplicates(edge)
    assert kept.schema.names == edge.schema.names
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(
        repr(doc) for doc, _, _, stays, _ in expected(edge_rows) if stays
    )


def test_native_plan(edge, capsys):
    exact_dedup(edge).explain()
    assert "Python" not in capsys.readouterr().out
