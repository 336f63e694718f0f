from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tagloom.llm.mixing import SCHEDULES, mix, plan_mix, position, targets


def wanted(sizes, weights=(5, 2, 1)):
    """Targets by handing out the demand again until no source is over twice its size."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in sizes else []
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, demand = {}, 1.5 * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        rest = demand - sum(full.values())
        shares = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if shares[s] > 2 * sizes[s]]
        if not over:
            return full | shares
        full |= {s: 2.0 * sizes[s] for s in over}


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 10, "b": 1000, "c": 3, None: 50, "é": 70},
        {"a": 0, "b": 5},
        {f"s{i}": (i * 37) % 101 for i in range(40)},
        {"only": 8},
    ],
)
def test_targets(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in targets(table).collect()}
    assert found == pytest.approx(wanted(sizes))


def test_plan(edge, edge_rows):
    found = plan_mix(edge).collect()
    sizes = defaultdict(int)
    words = {}
    for i, (_, text, _, source) in enumerate(edge_rows):
        n = len((text or "").encode().split())
        words[i] = n
        sizes[source] += n
    assert sorted(((r.doc_id, r["size"]) for r in found), key=repr) == sorted(
        ((d, words[i]) for i, (d, *_) in enumerate(edge_rows)), key=repr
    )
    goal = wanted(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source])
        assert r.taken == r["size"] * r.copies <= 2 * r["size"]
        assert len(r.positions) == r.copies and all(0 <= p <= 1 for p in r.positions)
        assert sorted(r.positions) == r.positions
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for source, target in goal.items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1e-6


def test_reruns_agree(edge):
    one, two = (sorted(map(repr, plan_mix(edge.repartition(n)).collect())) for n in (2, 5))
    assert one == two


def test_positions_invert_the_schedule(spark):
    shares = spark.range(0, 1001).select((F.col("id") / 1000).alias("share"))
    for number, knots in enumerate(SCHEDULES):
        area = sum((t1 - t0) * (a + b) / 2 for (t0, a), (t1, b) in zip(knots, knots[1:]))

        def met(t, knots=knots, area=area):
            total = 0.0
            for (t0, a), (t1, b) in zip(knots, knots[1:]):
                x = min(max(t, t0), t1) - t0
                total += a * x + (b - a) / (t1 - t0) * x * x / 2
            return total / area

        for r in shares.select("share", position(F.col("share"), F.lit(number)).alias("t")).collect():
            assert met(r.t) == pytest.approx(r.share, abs=1e-9)


def test_sources_follow_their_schedules(spark):
    docs = spark.range(0, 6000, 1, 4).select(
        F.col("id").alias("doc_id"),
        F.lit("one two three four").alias("text"),
        F.concat(F.lit("s"), F.col("id") % 3).alias("source"),
    )
    early = {
        r.source: r.early
        for r in plan_mix(docs)
        .select("source", F.explode("positions").alias("p"))
        .groupBy("source")
        .agg(F.avg((F.col("p") < 0.5).cast("int")).alias("early"))
        .collect()
    }
    assert early["s0"] == pytest.approx(0.5, abs=0.01)
    assert early["s1"] == pytest.approx(1 / 3, abs=0.01)
    assert early["s2"] == pytest.approx(2 / 3, abs=0.01)


def test_mix_returns_documents_in_order(edge, empty):
    out = mix(edge)
    assert out.schema.names == edge.schema.names
    plan = plan_mix(edge)
    order = sorted(((p, r.doc_id) for r in plan.collect() for p in r.positions), key=lambda x: (x[0], x[1] or -1))
    assert [r.doc_id for r in out.collect()] == [d for _, d in order]
    assert mix(empty).count() == 0 and plan_mix(empty).count() == 0
