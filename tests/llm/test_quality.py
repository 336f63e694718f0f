from collections import Counter

from tagloom.llm.quality import MEASURES, POLICIES, RULES, ablations, judged, keep_good, ledger, mask


def measured(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, step by step."""
    text = text or ""
    for c in "\t\n\v\f\r":
        spaced = text if c == "\n" else text.replace(c, " ")
        text = spaced
    words = text.replace("\n", " ").split(" ")
    words = [w for w in words if w]
    lines = [line for line in text.split("\n") if line.strip(" ")]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_measures(edge, edge_rows):
    found = sorted(((r.doc_id, *(r[m] for m in MEASURES[:5])) for r in ledger(edge).collect()), key=repr)
    assert found == sorted(((d, *measured(t)) for d, t, *_ in edge_rows), key=repr)


def test_base_rule(edge, edge_rows):
    for r in judged(edge).collect():
        base = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == base
        assert not (base and r.kept)


def test_policies_need_the_ledger_only(edge):
    rows = ledger(edge)
    for policy, rules in POLICIES.items():
        by_bits = {r.doc_id for r in rows.collect() if not r.fail_bits & mask(rules)}
        assert {r.doc_id for r in judged(edge, policy).where("kept").collect()} == by_bits


def test_ablations(edge):
    bits = [r.fail_bits for r in ledger(edge).collect()]
    found = {(r.policy, r.rule): (r.n_failed, r.n_only) for r in ablations(ledger(edge)).collect()}
    for policy, rules in POLICIES.items():
        for rule in rules:
            one = mask((rule,))
            failed = sum(1 for b in bits if b & one)
            only = sum(1 for b in bits if b & mask(rules) == one)
            assert found[policy, rule] == (failed, only)


def test_junk_and_clean(spark):
    clean = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    texts = [
        (1, clean),
        (2, " ".join(w + "%%%" for w in clean.split())),
        (3, clean.upper()),
        (4, "same line here\n" * 9 + clean),
        (5, clean + " again and again and so" * 9),
        (6, "a b c d e f g h i j k"),
        (7, "too few"),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    failed = {r.doc_id: [n for i, n in enumerate(RULES) if r.fail_bits >> i & 1] for r in ledger(docs).collect()}
    assert failed[1] == []
    assert "symbols" in failed[2] and "upper_case" in failed[3] and "repeated_lines" in failed[4]
    assert "repeated_words" in failed[5] and "word_length" in failed[6] and "few_words" in failed[7]
    assert [r.doc_id for r in keep_good(docs).collect()] == [1]


def test_columns_and_empty(edge, empty):
    assert keep_good(edge).schema.names == edge.schema.names
    assert judged(empty).count() == 0 and keep_good(empty).count() == 0
    assert ablations(ledger(empty)).count() == 0
