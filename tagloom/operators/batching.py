"""Batches of bounded size, and their names.

``assign_batches`` is next-fit: items of a group are taken in order, and an item
that would lift the running size over the limit starts the next batch. That is
sequential, so a group that holds a large part of all items needs care. The
items are sorted over all tasks by (group, order); a task then describes what its
share does to *any* running size it may start with. This depends only on where
the first new batch begins, so the description has at most as many rows as one
batch has items. Putting the descriptions together, in one row of partitions,
gives each task its true starting point, from which it numbers its items. No
task ever holds more than an Arrow batch of a group.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.schemas import MAX_BATCH_BYTES
from tagloom.sources.tables import shared_dir

_FIRST, _SUM, _LAST = 0, 1, 2  # roles of description rows


class _Chunk:
    """Next-fit over some consecutive sizes of one group."""

    def __init__(self, sizes: np.ndarray, limit: int):
        self.limit = limit
        self.upto = np.cumsum(sizes)
        self.before = self.upto - sizes
        # Where the batch that starts at an item ends: the next batch's start.
        ends = np.searchsorted(self.upto, self.before + limit, side="right")
        self.next = np.maximum(np.arange(len(sizes)) + 1, ends)

    def first_start(self, totals):
        """Index of the first item that starts a batch, given the running size."""
        return np.searchsorted(self.upto, self.limit - totals, side="right")

    def starts(self, total: int) -> list[int]:
        found, i = [], int(self.first_start(total))
        while i < len(self.next):
            found.append(i)
            i = int(self.next[i])
        return found

    def outcomes(self) -> tuple[np.ndarray, np.ndarray]:
        """Per item, if a batch starts there: running size at the end, batches begun."""
        n = len(self.next)
        last, begun = list(range(n)), [1] * n
        following = self.next.tolist()
        for i in range(n - 1, -1, -1):
            j = following[i]
            if j < n:
                last[i], begun[i] = last[j], 1 + begun[j]
        return self.upto[-1] - self.before[last], np.array(begun, dtype=np.int64)

    def finish(self, total: int) -> tuple[int, int]:
        """Running size at the end and batches begun, given the running size."""
        starts = self.starts(total)
        if not starts:
            return total + int(self.upto[-1]), 0
        return int(self.upto[-1] - self.before[starts[-1]]), len(starts)


class _Description:
    """What a run of items does to any running size it may start with."""

    def __init__(self, limit: int):
        self.limit = limit
        self.sum = 0
        self.prefix = np.empty(0, dtype=np.int64)  # run sums at possible first starts
        self.total = np.empty(0, dtype=np.int64)  # running size at the end, for each
        self.begun = np.empty(0, dtype=np.int64)  # batches begun, for each

    def extend(self, chunk: _Chunk) -> None:
        total, begun = chunk.outcomes()
        at = chunk.first_start(self.total)
        goes_on = at < len(total)
        inside = np.minimum(at, len(total) - 1)
        self.begun = self.begun + np.where(goes_on, begun[inside], 0)
        self.total = np.where(goes_on, total[inside], self.total + chunk.upto[-1])
        # A running size of 0 or more passes the limit at the latest where the
        # run alone does; an item of size 0 is not the one that passes it.
        if self.sum <= self.limit:
            grows = chunk.upto > chunk.before
            if not len(self.prefix):
                grows[0] = True  # a running size above the limit ends at once
            new = grows & (self.sum + chunk.before <= self.limit)
            self.prefix = np.concatenate([self.prefix, self.sum + chunk.upto[new]])
            self.total = np.concatenate([self.total, total[new]])
            self.begun = np.concatenate([self.begun, begun[new]])
        self.sum += int(chunk.upto[-1])


def _runs(batch: pa.RecordBatch, group: str, size: str) -> Iterator[tuple[object, int, np.ndarray]]:
    """Consecutive rows of one group: key, offset, sizes."""
    codes = batch.column(group).dictionary_encode(null_encoding="encode").indices
    bounds = np.flatnonzero(np.diff(codes.to_numpy(zero_copy_only=False))) + 1
    sizes = batch.column(size).to_numpy(zero_copy_only=False)
    edges = [0, *bounds.tolist(), batch.num_rows]
    for start, stop in zip(edges, edges[1:]):
        yield batch.column(group)[start].as_py(), start, sizes[start:stop]


def _describe(limit: int):
    """Task over a sorted partition: describe its first and its last group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = first_key = last_key = description = key_type = None
        total = begun = 0
        for batch in batches:
            key_type = batch.schema.field("_group").type
            for key, _, sizes in _runs(batch, "_group", "_size"):
                chunk = _Chunk(sizes, limit)
                if description is None:
                    part = batch.column("_part")[0].as_py()
                    first_key, description = key, _Description(limit)
                    description.extend(chunk)
                elif last_key is None and key == first_key:
                    description.extend(chunk)
                else:
                    if last_key is None or key != last_key[0]:
                        last_key, total, begun = (key,), 0, 0
                    total, more = chunk.finish(total)
                    begun += more
        if description is None:
            return
        rows = [
            (_FIRST, first_key, *row)
            for row in zip(
                description.prefix.tolist(), description.total.tolist(), description.begun.tolist()
            )
        ]
        rows.append((_SUM, first_key, description.sum, 0, 0))
        if last_key is not None:
            rows.append((_LAST, last_key[0], 0, total, begun))
        role, keys, prefix, totals, begun_all = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part] * len(rows), pa.int32()),
                pa.array(role, pa.int32()),
                pa.array(keys, key_type),
                pa.array(prefix, pa.int64()),
                pa.array(totals, pa.int64()),
                pa.array(begun_all, pa.int64()),
            ],
            names=["_part", "_role", "_group", "_prefix", "_total", "_begun"],
        )

    return run


def _put_together(limit: int):
    """Task over all descriptions, sorted: true start of every partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, totals, indexes = [], [], []
        carried = None  # (key, running size, batch index) after the partitions so far
        state = None  # the same within the present partition
        fired = False
        for batch in batches:
            for row in batch.to_pylist():
                if state is None or row["_part"] != parts[-1]:
                    carried = state
                    key = row["_group"]
                    if carried is None or carried[0] != key:
                        carried = (key, 0, 1)
                    state, fired = carried, False
                    parts.append(row["_part"])
                    totals.append(carried[1])
                    indexes.append(carried[2])
                if row["_role"] == _FIRST:
                    if not fired and carried[1] + row["_prefix"] > limit:
                        fired = True
                        state = (carried[0], row["_total"], carried[2] + row["_begun"])
                elif row["_role"] == _SUM:
                    if not fired:
                        state = (carried[0], carried[1] + row["_prefix"], carried[2])
                else:
                    state = (row["_group"], row["_total"], 1 + row["_begun"])
        if parts:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(parts, pa.int32()),
                    pa.array(totals, pa.int64()),
                    pa.array(indexes, pa.int64()),
                ],
                names=["_part", "_start_total", "_start_index"],
            )

    return run


def _number(limit: int, outputs: list[str]):
    """Task over a sorted partition with its true start: number the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None  # (key, running size, batch index)
        for batch in batches:
            numbers = np.empty(batch.num_rows, dtype=np.int64)
            for key, start, sizes in _runs(batch, "_group", "_size"):
                if state is None:
                    state = (
                        key,
                        batch.column("_start_total")[start].as_py(),
                        batch.column("_start_index")[start].as_py(),
                    )
                elif state[0] != key:
                    state = (key, 0, 1)
                chunk = _Chunk(sizes, limit)
                steps = np.zeros(len(sizes), dtype=np.int64)
                steps[chunk.starts(state[1])] = 1
                index = state[2] + np.cumsum(steps)
                numbers[start : start + len(sizes)] = index
                state = (key, chunk.finish(state[1])[0], int(index[-1]))
            arrays = [batch.column(name) for name in outputs]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(numbers, pa.int64())], names=[*outputs, "batch_index"]
            )

    return run


def assign_batches(
    items: DataFrame,
    group: str = "folder",
    order: str | tuple[str, ...] = "file",
    size: str = "bytes",
    max_size: int = MAX_BATCH_BYTES,
) -> DataFrame:
    """Adds batch_index (from 1 per group) and batch_name (group and index).

    ``order`` must be unique within a group, sizes must not be negative. An
    item above the limit has a batch of its own; if it comes first, batch 1
    stays empty. Give narrow rows (keys and sizes, not contents): the sorted rows
    are checkpointed, so that all steps see the same partitions even if
    executors are lost.
    """
    order = (order,) if isinstance(order, str) else order
    shared_dir(items.sparkSession)
    placed = (
        items.repartitionByRange(group, *order)
        .sortWithinPartitions(group, *order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_group", F.col(group))
        .withColumn("_size", F.coalesce(F.col(size).cast("long"), F.lit(0)))
        .checkpoint()
    )
    group_type = placed.schema["_group"].dataType.simpleString()
    described = placed.select("_part", "_group", "_size").mapInArrow(
        _describe(max_size),
        f"_part int, _role int, _group {group_type}, _prefix long, _total long, _begun long",
    )
    # One task, but over a few rows per partition, whatever the number of items.
    starts = (
        described.repartition(1)
        .sortWithinPartitions("_part", "_role", "_prefix")
        .mapInArrow(_put_together(max_size), "_part int, _start_total long, _start_index long")
    )
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    # ``starts`` has one row per partition, a proven bound for the broadcast.
    numbered = placed.join(F.broadcast(starts), "_part").mapInArrow(
        _number(max_size, items.columns), f"{fields}, batch_index long"
    )
    return numbered.withColumn("batch_index", F.col("batch_index").cast("int")).withColumn(
        "batch_name", F.concat(F.col(group).cast("string"), F.col("batch_index").cast("string"))
    )


def _index(folder: str) -> Column:
    return F.regexp_extract("batch_name", rf"^{re.escape(folder)}(\d+)$", 1)


def batches_of(batches: DataFrame, folder: str) -> DataFrame:
    """Batches whose name is the folder's name and a number, and nothing else."""
    return batches.where(_index(folder) != "")


def max_batch_index(batches: DataFrame, folder: str) -> DataFrame:
    """One row with ``max_index``, the largest batch number of a folder; 0 if none."""
    return batches_of(batches, folder).agg(
        F.coalesce(F.max(_index(folder).cast("int")), F.lit(0)).alias("max_index")
    )
