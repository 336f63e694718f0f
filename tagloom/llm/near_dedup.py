"""Near duplicates by fast similarity sketches, banding and exact verification.

A document is the set of its shingles of ``words`` words. Its sketch has ``ROWS *
BANDS`` coordinates. In round after round every shingle is thrown into one bin by
a hash of that round; a bin takes the smallest value of the first round that
reaches it. After as many rounds as bins, each further round serves one bin with
all shingles, so no coordinate stays empty. Two sets agree in a coordinate with
the probability of their similarity, about as concentrated as with independent
hashes, but most sets need a few rounds only.

Documents with equal sets are one class, and only classes go on. Those that
share a band meet in a bucket. A shingle that no other class in any bucket has
cannot be shared, which bounds the similarity of a pair from above (exactly), and
so do parities: of the shingles dealt to ``PARITIES`` groups by hash, a group with
an odd number in one set and an even one in the other holds a shingle that they
do not share. Classes and pairs that cannot reach ``percent`` go no further. No bucket emits all
its pairs: first, everyone in it is compared with one pivot, and classes found
similar become one component. What different components still have in common
buckets is looked at when that is little (``LEFT_OVER`` pairs per class), else with
more pivots, ``FASTER`` times as many each time, until no pair of different
components that shares a bucket is left. Pairs within a component need no
comparison. Every comparison is exact, on the full sets.

A pair of similarity 0.8 shares no band with probability (1 - 0.8^5)^40 < 2e-7.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import lean_batches, staged, with_key
from tagloom.llm.components import components
from tagloom.llm.encoding import give_back

WORDS = 4
#: Bands are laid out for this similarity; smaller ones they would miss too often.
PERCENT = 80
ROWS = 5
BANDS = 40
LEFT_OVER = 256
FASTER = 8
PARITIES = 1024

_LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = 0x9E3779B97F4A7C15
_SMALL = 24


def _mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _seed(i: int) -> np.uint64:
    return np.uint64((i + 1) * _GOLD & 0xFFFFFFFFFFFFFFFF)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the different shingles; a shorter text is one shingle."""
    import xxhash

    parts = (text or "").encode("utf-8", "replace").translate(_LOWER).split()  # ASCII white space
    if not parts:
        return np.zeros(0, np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    size = min(words, len(parts))
    n = len(parts) - size + 1
    code = np.full(n, size, np.uint64)
    for i in range(size):
        code = _mix(code * np.uint64(_GOLD) + one[i : i + n])
    return np.unique(code)


def sketch(found: np.ndarray, bins: int = ROWS * BANDS) -> np.ndarray:
    """The coordinates of a set that is not empty: round and value as one number."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(bins, empty)
    if len(found) <= _SMALL:
        # All rounds at once.
        rounds = np.arange(bins, dtype=np.uint64)[:, None]
        h = _mix(found[None, :] ^ _mix(rounds * np.uint64(_GOLD) + np.uint64(_GOLD)))
        bin_of = ((h >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
        value = rounds << np.uint64(32) | (h & np.uint64(0xFFFFFFFF))
        np.minimum.at(out, bin_of.ravel().astype(np.int64), value.ravel())
    else:
        for i in range(bins):
            h = _mix(found ^ _mix(_seed(i)[None])[0])
            bin_of = (((h >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)
            value = np.uint64(i << 32) | (h & np.uint64(0xFFFFFFFF))
            np.minimum.at(out, bin_of, value)  # values of later rounds are larger
            if not (out == empty).any():
                break
    for i in np.flatnonzero(out == empty).tolist():
        h = _mix(found ^ _mix(_seed(bins + i)[None])[0])
        out[i] = np.uint64((bins + i) << 32) | (h & np.uint64(0xFFFFFFFF)).min()
    return out


def bands(coordinates: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each band, different for different bands."""
    by_band = coordinates.reshape(-1, rows)
    key = np.arange(len(by_band), dtype=np.uint64)
    for i in range(rows):
        key = _mix(key * np.uint64(_GOLD) + by_band[:, i])
    return key.view(np.int64)


def _sketched(words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            sizes, digests, keys = [], [], []
            for text in batch.column("text"):
                found = shingles(text.as_py(), words)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                keys.append(bands(sketch(found)) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("content"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["doc_id", "content", "n_shingles", "digest", "bands"],
            )
        give_back()

    return sketched


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether two classes may be similar enough: they share no shingle that is their own."""
    shared = F.least(F.col(f"n_{a}") - F.col(f"own_{a}"), F.col(f"n_{b}") - F.col(f"own_{b}"))
    return (100 + percent) * shared >= percent * (F.col(f"n_{a}") + F.col(f"n_{b}"))


def _agreeing(a: str, b: str, percent: int) -> Column:
    """Whether the parities of two classes leave it possible that they are similar enough."""
    different = sum(
        (F.bit_count(F.get(f"parities_{a}", F.lit(i)).bitwiseXOR(F.get(f"parities_{b}", F.lit(i)))) for i in range(PARITIES // 64)),
        F.lit(0),
    )
    return (100 + percent) * different <= (100 - percent) * (F.col(f"n_{a}") + F.col(f"n_{b}"))


def parities(found: np.ndarray) -> np.ndarray:
    """For each group whether a set has an odd number of its shingles, as bits."""
    odd = np.bincount((found % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """node, set and parities of the rows whose text has the set that the node stands for."""

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            nodes, sets, odd = [], [], []
            for node, digest, text in zip(*(batch.column(c) for c in ("node", "digest", "text")), strict=True):
                found = shingles(text.as_py(), words)
                if xxhash.xxh3_128_digest(found.tobytes()) == digest.as_py():
                    nodes.append(node.as_py())
                    sets.append(found.view(np.int64))
                    odd.append(parities(found))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(sets, longs), pa.array(odd, longs)], ["node", "set", "parities"]
            )

    return sets_of


def _similar(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The pairs (a, b) whose sets are similar enough."""

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                a, b = (s.values.to_numpy().view(np.uint64) for s in (x, y))
                if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                    linked.append(False)
                    continue
                small, large = (a, b) if len(a) < len(b) else (b, a)
                at = np.searchsorted(large, small)
                at[at == len(large)] = 0
                both = int(np.count_nonzero(large[at] == small))
                linked.append(100 * both >= percent * (len(a) + len(b) - both))
            chosen = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(chosen), batch.column("b").filter(chosen)], ["a", "b"]
            )
        give_back()

    return similar


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    a = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    b = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    with_sets = pairs.join(a, "a").join(b, "b").select("a", "b", "set_a", "set_b")
    return with_sets.mapInArrow(_similar(percent), "a long, b long")


def _crossing(members: DataFrame) -> DataFrame:
    """Members of buckets that still hold several components, with that bucket's size."""
    per_root = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    columns = [c for c in members.columns if c != "key"]
    open_buckets = (
        per_root.groupBy("key")
        .agg(F.count(F.lit(1)).alias("roots"), F.sum("n").alias("size"), F.sum(F.col("n") * F.col("n")).alias("within"))
        .where("roots > 1")
        .select("key", "size", ((F.col("size") * F.col("size") - F.col("within")) / 2).alias("pairs"))
    )
    return members.join(open_buckets, "key").select("key", *columns, "size", "pairs")


def _links(members: DataFrame, keys: DataFrame, sets: DataFrame, classes: int, percent: int) -> DataFrame:
    """a, b: enough similar pairs to connect all that share a bucket and are similar.

    ``members`` has key, node, n and own (sizes of its set and of the part that no
    other class has) of the buckets with two nodes or more, ``keys`` the bands and
    parities of each node.
    """

    def side(rows: DataFrame, name: str) -> DataFrame:
        columns = [F.col(c).alias(f"{c}_{name}") for c in ("node", "n", "own", "root", "bands", "parities") if c in rows.columns]
        return rows.select("key", *columns)

    # The most central class of a bucket is the one with the least of its own.
    central = F.struct((F.col("own") / F.col("n")).alias("part"), "node", "n", "own")
    pivots = members.groupBy("key").agg(F.min(central).alias("p")).select("key", "p.*")
    pairs = side(pivots, "a").join(side(members, "b"), "key").where("node_a != node_b")
    pairs = pairs.where(_possible("a", "b", percent)).select(
        F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")
    )
    tested = staged(pairs.distinct(), "tested")
    links = staged(_verified(tested, sets, percent), "links")
    share = 1
    while True:
        roots = components(links)
        labelled = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        left = staged(_crossing(labelled), "crossing")
        # A row per bucket would say the same; every member carries its bucket's number.
        count = left.agg(F.sum(F.col("pairs") / F.col("size"))).first()[0] or 0
        if not count:
            return links
        last = count <= LEFT_OVER * classes
        share *= FASTER
        chance = F.pmod(F.xxhash64("node", "key"), F.lit(1 << 30)) / float(1 << 30)
        pivot = F.lit(True) if last else (chance < share / F.col("size"))
        whole = last or not left.where(F.col("size") > share).limit(1).count()
        left = left.join(keys, "node")
        # Of the buckets that a pair shares, that of its first common band speaks for it.
        earlier = [F.slice(f"bands_{s}", F.lit(1), F.array_position("bands_x", F.col("key")).cast("int") - 1) for s in "xy"]
        once = ~F.arrays_overlap(*earlier) if last else F.lit(True)
        pairs = (
            side(left.withColumn("pivot", pivot).where("pivot"), "x")
            .join(side(left, "y"), "key")
            .where((F.col("root_x") != F.col("root_y")) & _possible("x", "y", percent) & _agreeing("x", "y", percent))
            .where((F.col("node_x") < F.col("node_y")) & once if last else F.lit(True))
            .select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b"))
            .distinct()
            .join(tested, ["a", "b"], "left_anti")
        )
        pairs = staged(pairs, "pairs")
        links = staged(links.unionByName(_verified(pairs, sets, percent)), "links")
        if whole:
            return links
        tested = tested.unionByName(pairs)


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, content, digest, root: one row per row of ``docs``.

    ``docs`` needs doc_id and text; other columns are ignored. ``component_id`` is
    the smallest doc_id that links lead to, null if all ids there are null.
    ``root`` tells components apart where ids are null or repeated: it is a
    number of one row of the component, null for texts without words. Texts
    without words (or null) have no shingles and no links: each is its own
    component. Repeated rows have equal results. An empty table gives an empty one.
    Sets of shingles of ``words`` words are linked from ``percent`` per cent
    similarity on.
    """
    if words < 1 or not PERCENT <= percent <= 100:
        raise ValueError(f"words must be 1 or more and percent from {PERCENT} to 100, not {words} and {percent}")
    lean_batches(docs.sparkSession)
    schema = "doc_id {}, content long, n_shingles long, digest binary, bands array<long>"
    rows = docs.select("doc_id", F.xxhash64("text").alias("content"), "text").mapInArrow(
        _sketched(words), schema.format(docs.schema["doc_id"].dataType.simpleString())
    )
    rows = staged(rows.withColumn("row_id", F.monotonically_increasing_id()), "sketches")
    with_words = rows.where("n_shingles > 0")
    classes = staged(
        with_words.groupBy("digest").agg(F.min("row_id").alias("node"), F.min("doc_id").alias("first_id")), "classes"
    )
    one_each = with_words.join(classes.select(F.col("node").alias("row_id")), "row_id", "left_semi")
    keyed = one_each.select(F.explode("bands").alias("key"), F.col("row_id").alias("node"))
    shared = staged(keyed.groupBy("key").count().where("count > 1").select("key"), "buckets")
    met = staged(keyed.join(shared, "key"), "met")

    wanted = with_words.join(met.select("node").distinct(), F.col("row_id") == F.col("node"), "left_semi").select(
        F.col("doc_id").alias("_id"), F.col("content").alias("_content"), F.col("row_id").alias("node"), "digest"
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_content"))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("_key")).join(wanted, same)
    sets = texts.select("node", "digest", "text").mapInArrow(_sets(words), "node long, set array<long>, parities array<long>")
    sets = staged(sets, "sets")
    if not sets.groupBy("node").count().where("count > 1").isEmpty():
        sets = staged(sets.dropDuplicates(["node"]), "sets")  # from repeated rows

    # Shingles that one class alone has, and classes that have too many of them for any link.
    own = sets.select("node", F.explode("set").alias("shingle")).groupBy("shingle").agg(
        F.count(F.lit(1)).alias("times"), F.min("node").alias("node")
    )
    own = own.where("times = 1").groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    known = with_words.select(F.col("row_id").alias("node"), F.col("n_shingles").alias("n"))
    hopeful = (
        sets.select("node")
        .join(own, "node", "left")
        .join(known, "node")
        .select("node", "n", F.coalesce("own", F.lit(0)).alias("own"))
        .where(100 * F.col("own") <= (100 - percent) * F.col("n"))
    )
    members = staged(met.join(hopeful, "node"), "members")
    keys = one_each.select(F.col("row_id").alias("node"), "bands").join(sets.select("node", "parities"), "node")
    roots = components(_links(members, keys, sets, classes.count(), percent))
    rooted = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_digest = rooted.join(smallest, "root").select("digest", "component_id", "root", F.lit(True).alias("linked"))
    return (
        rows.join(of_digest, "digest", "left")
        .withColumn("component_id", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("doc_id")))
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
            "content",
            "digest",
            "root",
        )
    )


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each component of ``docs``, columns as they were; texts without words stay.

    It is a row with the component's id (the smallest; null only if all ids of
    the component are null). If several rows of one component have that id, the
    one whose text has the smallest hash stays; repeated rows count once.
    Components are told apart by their root, not by their id, so different texts
    that share an id, or have none, are never merged. Null and empty texts have
    no words: each distinct (id, text) stays once. An empty table gives an empty
    one; very long texts are read whole.
    """
    found = near_duplicates(docs, words, percent).where("kept")
    one = found.where("n_shingles > 0").groupBy("root").agg(
        F.min(F.struct("content", "component_id")).alias("_pick")
    )
    one = one.select(F.col("_pick.component_id").alias("component_id"), F.col("_pick.content").alias("_content"))
    wordless = found.where("n_shingles = 0").select("component_id", F.col("content").alias("_content"))
    stay = one.unionByName(wordless).distinct().withColumnRenamed("component_id", "_id")
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_content"))
    keyed = with_key(docs, F.xxhash64("text"))
    return keyed.join(stay, same, "left_semi").dropDuplicates(["_doc", "_key"]).select("_all.*")
