import pytest
from pyspark.sql import functions as F

# A long word, so that long texts are made of something.
WORDS = ("amber birch cedar dune ember fjord grove heath islet jetty knoll lagoon marsh notch orchard prairie quarry "
         "ridge shoal tundra upland valley weir yonder zenith").split()  # fmt: skip


def prose(seed, n):
    """``n`` words that differ between seeds."""
    state, out = seed * 7919 + 1, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(WORDS[state // 65536 % len(WORDS)] + ("" if state % 3 else "s"))
    return " ".join(out)


A, B = prose(1, 80), prose(2, 120)
ROWS = [
    (10, A, "en", "s1"),
    (3, A.replace(" ", "\n\t ", 5), "en", "s2"),  # equal but for white space
    (11, A, "en", "s1"),
    (11, A, "en", "s1"),  # a repeated row
    (7, B, "de", None),
    (8, B + " tail", None, None),  # a near copy
    (20, None, "en", "s1"),
    (21, "", "en", "é"),
    (22, " \n\t ", "en", "é"),
    (23, "ab", None, "s1"),
    (24, "12 34 !! 56", "en", "s2"),
    (25, "<|endoftext|> don't  stop now 字字 ünï😀", "fr", "s2"),
    (30, prose(5, 30_000), "en", "big"),  # a very long text
    (None, "no id here " + prose(6, 20), "en", "s1"),
    (40, (prose(7, 12) + ". ") * 9, "en", "s2"),
    (41, "\n".join([prose(8, 6)] * 5 + [prose(9, 6)]), "en", "s2"),
    (42, "x" * 250, "en", "s2"),
    (43, prose(10, 60) + " " + A[100:300], "en", "s2"),
]
CLASHING = ["key", "norm", "kept", "size", "row_id", "count", "digest", "node", "_key", "_all", "_doc", "n_words",
            "shard", "units", "found", "bytes", "position", "hot", "salt", "doc"]


@pytest.fixture(scope="session")
def edge_rows():
    return ROWS


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names clash."""
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    for i, name in enumerate(CLASHING):
        docs = docs.withColumn(name, F.lit(i))
    return docs.repartition(3)


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
