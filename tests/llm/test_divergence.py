import re

from tagloom.llm.divergence import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs=3, top=200):
    """Every kept term in every group and every ordered pair of sources, in plain Python."""
    docs = [((lang or ""), (source or ""), [t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
             for t in TERM.findall(text or "")]) for _, text, lang, source in rows]
    out = []
    for lang in sorted({d[0] for d in docs}):
        mine = [d for d in docs if d[0] == lang]
        kept = sorted(t for t in {t for d in mine for t in d[2]} if sum(t in d[2] for d in mine) >= min_docs)
        V = len(kept)
        sources = sorted({d[1] for d in mine})
        count = {s: {t: sum(d[2].count(t) for d in mine if d[1] == s) for t in kept} for s in sources}
        every = {t: sum(count[s][t] for s in sources) for t in kept}

        def p_of(c):
            N = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 1) // (N + V) for t in kept}

        p = {s: p_of(count[s]) for s in sources}
        q = p_of(every)
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if count[s][t] > 0 and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(out)


def test_edge_rows(spark, edge, edge_rows):
    got = sorted(map(tuple, divergence(edge).collect()))
    assert got == brute(edge_rows)


def test_against_brute_force(spark):
    words = "alpha beta gamma delta Epsilon zeta eta theta iota kappa lambda mu".split()
    rows = []
    for i in range(60):
        text = " ".join(words[(i * k) % len(words)] for k in range(1, 2 + i % 9))
        rows.append((i, text, ["en", "de", None][i % 3], ["a", "b", "c", None, "é"][i % 5]))
    rows += [(99, "ünïcode Über über", "fr", "x"), (100, None, "fr", "y"), (100, None, "fr", "y")]  # a language without kept terms
    rows += [(101, "alpha alpha alpha", "solo", "z")] * 3  # one source: no pairs
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    got = sorted(map(tuple, divergence(docs, top=3).collect()))
    assert got == brute(rows, top=3)
    assert any(r[2] == "pair" and r[0] == "fr" and r[4] == 0 for r in got)


def test_empty(spark, empty):
    assert divergence(empty).count() == 0
