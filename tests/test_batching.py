import random

import pytest
from pyspark.sql import functions as F

import tagloom as tl

SCHEMA = "folder string, file int, bytes long"


def one_group(spark, sizes, limit):
    df = spark.createDataFrame([("f", i, s) for i, s in enumerate(sizes)], SCHEMA)
    found = tl.assign_batches(df, max_size=limit).orderBy("file").collect()
    return [r.batch_index for r in found], [r.batch_name for r in found]


def test_goldens(spark):
    indexes, names = one_group(spark, [4, 6, 1, 10, 11, 3], 10)
    assert indexes == [1, 1, 2, 3, 4, 5]
    assert names == ["f1", "f1", "f2", "f3", "f4", "f5"]
    assert one_group(spark, [11, 1], 10)[0] == [2, 3]
    assert one_group(spark, [11, 0, 10, 0], 10)[0] == [2, 3, 3, 3]


def next_fit(items, limit):
    found = {}
    for folder in {f for f, _, _ in items}:
        total, index = 0, 1
        for _, file, size in sorted(i for i in items if i[0] == folder):
            if total + size > limit:
                total, index = 0, index + 1
            total += size
            found[folder, file] = index
    return found


@pytest.mark.parametrize("seed,n,limit,rows_per_batch", [
    (1, 60, 10, 5), (2, 800, 100, 7), (3, 800, 20480, 16), (4, 800, 3, 3), (5, 1500, 7, 10000),
])
def test_equals_loop_with_a_hot_group(spark, seed, n, limit, rows_per_batch):
    rnd = random.Random(seed)
    sizes = [0, 0, 1, 2, 3, limit, limit + 1]
    items = [
        (
            rnd.choice(["hot", "hot", "hot", "a", "b"]),
            file,
            rnd.choice([*sizes, rnd.randint(0, limit)]),
        )
        for file in range(n)
    ]
    rnd.shuffle(items)
    settings = {
        "spark.sql.shuffle.partitions": "11",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows_per_batch),
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = spark.createDataFrame(items, SCHEMA)
        found = tl.assign_batches(df, max_size=limit)
        got = {(r.folder, r.file): r.batch_index for r in found.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == next_fit(items, limit)


def test_all_zero_sizes_then_oversize(spark):
    assert one_group(spark, [0] * 50 + [99] + [0] * 50, 10)[0] == [1] * 50 + [2] + [3] * 50


def test_no_items(spark):
    assert tl.assign_batches(spark.createDataFrame([], SCHEMA)).count() == 0


def test_names(spark, rows):
    names = ["svt1", "svt12", "svtnyheter1", "svt", "svtx", "a.b3", "aXb4"]
    df = spark.createDataFrame([(n,) for n in names], "batch_name string")
    assert rows(tl.batches_of(df, "svt")) == [("svt1",), ("svt12",)]
    assert rows(tl.batches_of(df, "a.b")) == [("a.b3",)]
    assert tl.max_batch_index(df, "svt").first()[0] == 12
    assert tl.max_batch_index(df, "none").first()[0] == 0


def test_other_key_types(spark):
    df = spark.createDataFrame([(7, "x", 5), (7, "y", 6), (8, "x", 5)], "g long, o string, s int")
    found = tl.assign_batches(df, "g", "o", "s", 10).orderBy("g", "o")
    assert [(r.batch_index, r.batch_name) for r in found.collect()] == [(1, "71"), (2, "72"), (1, "81")]
    assert found.where(F.col("s").isNull()).count() == 0
