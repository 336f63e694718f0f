import random
from collections import Counter

import pytest

import tagloom as tl
from tagloom.operators.merge import LITERAL_KEYS


def texts(spark, *lines):
    return spark.createDataFrame(
        [(i, t) for i, t in enumerate(lines)], "tweet_id long, text string"
    )


def counts(df):
    return {(r.window_size, r.word1, r.word2): r.word_count for r in df.collect()}


def literal_counts(df):
    return counts(tl.plain_counts(df))


CANONICAL = [
    ("a b a b", {(2, "a", "b"): 3, (3, "a", "a"): 1, (3, "b", "b"): 1, (4, "a", "b"): 1}),
    ("a a a a", {(2, "a", "a"): 3, (3, "a", "a"): 2, (4, "a", "a"): 1}),
    ("b a", {(2, "a", "b"): 1}),
    ("a", {}),
    ("", {}),
]
LITERAL = [
    ("a b a b", {(2, "a", "b"): 1, (3, "a", "a"): 1, (3, "b", "b"): 1, (4, "a", "b"): 1}),
    ("a a a a", {(2, "a", "a"): 4, (3, "a", "a"): 2, (4, "a", "a"): 1}),
    ("b a", {(2, "b", "a"): 1}),
    ("a", {}),
    ("", {}),
]


@pytest.mark.parametrize("text,expected", CANONICAL)
def test_canonical(spark, text, expected):
    assert counts(tl.word_pairs(texts(spark, text))) == expected


@pytest.mark.parametrize("text,expected", LITERAL)
def test_literal(spark, text, expected):
    assert literal_counts(tl.word_pairs(texts(spark, text), mode="literal")) == expected


def test_units_are_not_merged(spark):
    two = texts(spark, "a b", "b a")
    assert counts(tl.word_pairs(two)) == {(2, "a", "b"): 2}
    assert literal_counts(tl.word_pairs(two, mode="literal")) == {(2, "a", "b"): 1, (2, "b", "a"): 1}


def test_lines(spark):
    two = texts(spark, "a b\nb a")
    assert counts(tl.word_pairs(two, unit="line")) == {(2, "a", "b"): 2}
    assert counts(tl.word_pairs(two, kmax=2)) == {(2, "a", "b"): 2, (2, "b", "b"): 1}


def test_null_text_and_range(spark):
    assert counts(tl.word_pairs(texts(spark, None, "a b c"), kmin=3, kmax=3)) == {(3, "a", "c"): 1}
    with pytest.raises(ValueError):
        tl.word_pairs(texts(spark, "a"), kmin=3, kmax=2)


def fold(words, k):
    """Literal rule for one unit as a sequential fold (from the blueprint)."""
    stands = {}  # unordered pair -> (orientation, count)
    for a, b in zip(words, words[k - 1 :]):
        pair = (min(a, b), max(a, b))
        was, count = stands.get(pair, (None, 0))
        if a == b:
            count = 2 * count if count else 1
        elif was is None or was == (a, b):
            count += 1
        stands[pair] = ((a, b), count)
    return list(stands.values())


def random_texts(seed, n=120):
    rnd = random.Random(seed)
    lines = [
        " ".join(rnd.choices("abcdefg", k=rnd.randint(0, 25), weights=[9, 5, 3, 2, 1, 1, 1]))
        for _ in range(n)
    ]
    return lines + lines[: n // 3]  # copies


@pytest.mark.parametrize("seed", [1, 2])
def test_literal_equals_fold(spark, seed):
    lines = random_texts(seed)
    expected = Counter()
    for line in lines:
        for k in range(2, 11):
            for (a, b), count in fold(line.split(), k):
                expected[k, a, b] += count
    assert literal_counts(tl.word_pairs(texts(spark, *lines), mode="literal")) == expected


@pytest.mark.parametrize("kmin,kmax", [(2, 10), (2, 40)])
def test_canonical_equals_loop(spark, kmin, kmax):
    lines = random_texts(3)
    expected = Counter()
    for line in lines:
        words = line.split()
        for k in range(kmin, kmax + 1):
            for a, b in zip(words, words[k - 1 :]):
                expected[k, min(a, b), max(a, b)] += 1
    assert counts(tl.word_pairs(texts(spark, *lines), kmin=kmin, kmax=kmax)) == expected


def test_large_literal_counts(spark, rows):
    df = texts(spark, "x " * 40, "x " * 40, "x " * 32)
    literal = tl.word_pairs(df, mode="literal")
    # Windows of k over n words give n - k + 1 pairs.
    folded = literal_counts(literal)
    assert all(folded[k, "x", "x"] == 2 * 2 ** (40 - k) + 2 ** (32 - k) for k in range(2, 11))
    over = tl.literal_overflow(literal)
    assert (2, "x", 39, 2) in rows(over) and (9, "x", 32, 2) in rows(over)
    assert len(rows(over)) == 8
    assert counts(tl.word_pairs(df))[2, "x", "x"] == 39 + 39 + 31


def test_no_literal_count_is_too_large(spark, rows):
    df = texts(spark, "x " * 500, "x " * 500, "x y")
    literal = tl.word_pairs(df, mode="literal", kmax=2)
    assert rows(literal) == [(2, "x", "x", 498, 2), (2, "x", "y", 0, 1)]
    assert rows(tl.merge_add(literal, literal, LITERAL_KEYS, "word_count"))[0][-1] == 4
    with pytest.raises(Exception, match="does not fit 64 bits"):
        tl.plain_counts(literal).collect()
    with pytest.raises(Exception, match="does not fit 64 bits"):
        tl.plain_counts(tl.word_pairs(texts(spark, *["x " * 64] * 2), mode="literal", kmax=2)).collect()


def test_other_window_sizes_are_an_error(spark):
    pairs = tl.unit_pairs(texts(spark, "a b c d"), kmax=4)
    for windows in (range(2, 4), range(2, 100, 2)):
        with pytest.raises(Exception, match="unexpected window size"):
            tl.count_pairs(pairs, windows=windows).collect()


def test_combining_changes_nothing(spark, rows):
    df = texts(spark, "a b a", "a b a", None, "b c")
    assert rows(tl.word_pairs(df, combine=True)) == rows(tl.word_pairs(df))


def test_batch_filter(spark):
    df = spark.createDataFrame(
        [(1, "a b", "x"), (2, "c d", "y")], "tweet_id long, text string, batch_name string"
    )
    assert counts(tl.word_pairs(df, batch="x")) == {(2, "a", "b"): 1}
    assert len(counts(tl.word_pairs(df, batch="None"))) == 2
    assert counts(tl.word_pairs(df, batch="z")) == {}


def test_same_hash_units_stay_apart(spark, monkeypatch):
    """Were all texts to share a hash, the unit number would still part them."""
    from pyspark.sql import functions as F

    from tagloom.operators import units as module

    class Colliding:
        def __getattr__(self, name):
            return getattr(F, name)

        def xxhash64(self, *_):
            return F.lit(1).cast("long")

    monkeypatch.setattr(module, "F", Colliding())
    two = texts(spark, "a b", "b a", "a b")
    assert literal_counts(tl.word_pairs(two, mode="literal")) == {(2, "a", "b"): 2, (2, "b", "a"): 1}


def test_lemmas(spark, rows):
    lexicon = spark.createDataFrame(
        [("is", "be"), ("the", None), ("a", ""), ("du", "de le"), ("it", "z"), ("it", "i")],
        "form string, lemma string",
    )
    df = texts(spark, "it is the cat", "a the", "du chat", "the dog is a dog")
    spoken = tl.lemmatise(tl.with_words(df), lexicon, keys=("tweet_id",))
    assert rows(spoken) == [
        (0, ["i", "be", "cat"]),
        (2, ["de", "le", "chat"]),
        (3, ["dog", "be", "dog"]),
    ]
    assert counts(tl.word_pairs(df, lexicon=lexicon, kmax=2)) == {
        (2, "be", "i"): 1,
        (2, "be", "cat"): 1,
        (2, "de", "le"): 1,
        (2, "chat", "le"): 1,
        (2, "be", "dog"): 2,
    }


def test_large_lexicon_joins_without_broadcast(spark):
    lexicon = spark.range(1000).selectExpr("concat('w', id) AS form", "concat('l', id) AS lemma")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = texts(spark, "cat dog")
        assert counts(tl.word_pairs(df, lexicon=lexicon)) == {(2, "cat", "dog"): 1}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
