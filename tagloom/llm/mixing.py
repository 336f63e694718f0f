"""Mixing sources to target weights by a time-varying curriculum.

A source's weight says how many words it gives, its schedule when. A schedule is
a density over training time 0 to 1, linear between knots; its integral says
which part of the source's demand has been met by then. Each document of a source
covers a stretch of the demand (the words before it, in an order that a hash
decides), and where the integral reaches the middle of that stretch, the document
is trained on. Sorting by that position in ranges gives the training order. A
source whose demand exceeds its size goes round again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import WORD, hash52, once_per_key, running, spread, text_or_empty, with_key

WEIGHTS = (5, 2, 1)
#: Demand as a part of all sizes, in halves: three halves are 150 %.
DEMAND_HALVES = 3
MAX_PASSES = 2

Knots = Sequence[tuple[float, float]]

#: By place of the weight: level, rising, falling. (time, density up to a factor)
SCHEDULES: tuple[Knots, ...] = (
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 1.0), (0.5, 1.0), (1.0, 3.0)),
    ((0.0, 3.0), (0.5, 1.0), (1.0, 1.0)),
)


def n_words(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """source, rank, source_size, target: words to take of each source.

    ``sources`` has a row per source with source and source_size. They weigh
    ``weights`` in turn, by code point, null last. Sources sorted by the level at
    which they reach ``MAX_PASSES`` times their size fill up one after the other;
    the highest level that the rest of the demand gives the rest of the weights
    is the one at which all of it is met.
    """
    ranked = sources.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    full = F.col("source_size") * MAX_PASSES
    ranked = ranked.withColumn("weight", weight.cast("long")).withColumn("full", full)
    by_level = Window.orderBy(F.col("full") / F.col("weight"), "rank")
    filled = F.coalesce(F.sum("full").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy())
    ranked = ranked.withColumn("level", (DEMAND_HALVES * total - 2 * filled) / (2 * left))
    level = F.max("level").over(Window.partitionBy())
    return ranked.select(
        "source",
        "rank",
        "source_size",
        F.least(F.col("full").cast("double"), level * F.col("weight")).alias("target"),
    )


def _stretches(knots: Knots) -> list[tuple[float, float, float, float]]:
    """(time, demand met until then, density, its slope) of each piece of a schedule."""
    area = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))
    found, met = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        found.append((t0, met, w0 / area, (w1 - w0) / area / (t1 - t0)))
        met += (t1 - t0) * (w0 + w1) / 2 / area
    return found


def position(share: Column, schedule: Column, schedules: Sequence[Knots] = SCHEDULES) -> Column:
    """The time at which a schedule (by number) has met a share of its demand."""
    found = F.lit(None).cast("double")
    for number, knots in enumerate(schedules):
        time = F.lit(None).cast("double")
        for start, met, density, slope in _stretches(knots):
            rest = share - met
            inside = start + 2.0 * rest / (density + F.sqrt(density * density + 2.0 * slope * rest))
            time = inside if not met else F.when(share >= met, inside).otherwise(time)
        found = F.when(schedule == number, F.least(time, F.lit(1.0))).otherwise(found)
    return found


def plan_mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, content, size, source_size, target, copies, taken, positions: a row per row of ``docs``.

    ``docs`` needs doc_id, text and source; other columns are ignored. Null texts
    have size 0, null is a source of its own. A document is taken in a pass if the
    middle of its stretch lies within the target, so a source's ``taken`` is off by
    half a document at most, and no document is taken more than ``MAX_PASSES``
    times. Repeated rows lie next to each other and count each for itself. Without
    any word nothing is taken. ``content`` is a hash of text and source.
    """
    sized = docs.select(
        "doc_id",
        "source",
        F.xxhash64("text", "source").alias("content"),
        n_words().alias("size"),
        hash52("mix", F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias("order"),
    )
    rows = spread(sized, "source", "order", "doc_id", "size")
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    sources = sources.withColumnRenamed("source", "_source")
    begun = running(rows, F.col("size"), "before", "source")
    placed = begun.join(sources, F.col("source").eqNullSafe(F.col("_source")))
    room = 2 * F.col("target") - 2 * F.col("before") - F.col("size")
    copies = F.when(
        (F.col("source_size") > 0) & (room >= 0),
        F.least(F.floor(room / (2 * F.col("source_size"))) + 1, F.lit(MAX_PASSES)),
    ).otherwise(0)
    placed = placed.withColumn("copies", copies.cast("int"))

    def at(one: Column) -> Column:
        middle = F.col("source_size") * one + F.col("before") + F.col("size") / 2
        return position(F.least(middle / F.col("target"), F.lit(1.0)), F.col("rank") % len(SCHEDULES))

    passes = [F.when(F.col("copies") > i, at(F.lit(i))) for i in range(MAX_PASSES)]
    return placed.select(
        "doc_id",
        "source",
        "content",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
        F.array_compact(F.array(*passes)).alias("positions"),
    )


def in_training_order(rows: DataFrame, position: str, *ties: str) -> DataFrame:
    """Rows sorted by their position in ranges; those without one come last."""
    order = [F.col(c).asc_nulls_last() for c in (position, *ties)]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def mix(docs: DataFrame) -> DataFrame:
    """The documents in training order, as often as they are taken; columns as they were.

    Rows that share doc_id, source and text are told apart no further.
    """
    plan = plan_mix(docs).where("copies > 0").select(
        F.col("doc_id").alias("_id"),
        F.col("content").alias("_content"),
        F.explode("positions").alias("_position"),
    )
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_content"))
    once = once_per_key(with_key(docs, F.xxhash64("text", "source")))
    return in_training_order(once.join(plan, same), "_position", "_id").select("_all.*")
