import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import tagloom as tl

CLEANED = [
    ("RT @user_1: Kolla https://t.co/AbC ÅÄÖ café №5!", "rt user kolla åäö caf"),
    ("awwww cute", "a cute"),
    ("foohttp bar", "foohttp bar"),
    ("xhttps://t.co/1y z", "x z"),
    ("HTTP://X.SE", ""),
    ("", ""),
    (None, None),
    ("a b c\u001cd　e\u0085f", "a b c d e f"),
    ("  two\n\tlines ", "two lines"),
]


def cleaned(spark, texts, **flags):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return [r[0] for r in df.select(tl.clean_text("text", **flags)).collect()]


def test_clean_goldens(spark):
    assert cleaned(spark, [t for t, _ in CLEANED]) == [c for _, c in CLEANED]


def test_flags(spark):
    text = ["See http://x.se/1 №5 ok٣!"]
    assert cleaned(spark, text, remove_urls=False) == ["see httpxse ok"]
    assert cleaned(spark, text, remove_special_chars=False) == ["see № ok!"]
    kept = cleaned(spark, text, remove_special_chars=False, remove_digits=False)
    assert kept == ["see №5 ok٣!"]


def by_hand(text):
    """The rules of the blueprint with Python's regular expressions."""
    text = re.sub(r"(http|www)\S+", "", text.lower())
    text = "".join(c for c in text if c.isspace() or c in "abcdefghijklmnopqrstuvwxyzåäö")
    return " ".join(text.split())


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.text(alphabet=st.sampled_from("aB wWhtpsåÄé1_#:/.\n\t  \u001f​"), max_size=30),
        min_size=1,
        max_size=40,
    )
)
def test_clean_equals_rules(spark, texts):
    assert cleaned(spark, texts) == [by_hand(t) for t in texts]


@pytest.mark.parametrize(
    "text,expected",
    [("", []), (" a  b\tc ", ["a", "b", "c"]), (" x y", ["x", "y"]), ("  ", [])],
)
def test_tokens(spark, text, expected):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(tl.tokens("text")).first()[0] == expected
