"""Repeated passages by prefix doubling, on sampled positions.

Prefix doubling names every position by the string of length 1, 2, 4, ... that
begins there: the name at twice the length is the pair of the names at the
position and one length further on. Positions whose name is unique are done, and
past the threshold equal names are repeats. Taken literally, Spark would sort
all bytes' positions in every round, many times the input. Three things keep the
outcome and save the sorts:

* Names are hashes of the pairs, the same everywhere, so rounds up to ``core``
  bytes (half the threshold at most) need no sorting; each task doubles them over
  its own texts.
* The first sort takes a sample of positions, chosen by content: of the core
  names in a window of ``threshold`` bytes the smallest is the window's anchor, and
  the windows of a document that share an anchor are a unit. Equal windows have
  equal anchors. Spark sorts the units by (name of the core at the anchor, name of
  the whole unit, position). A core that occurs once: no window of the unit
  repeats. A unit after the first of its name: all its windows repeat.
* What is left are first units whose core also occurs in other units. Only their
  windows, at every byte, are named at the threshold and sorted by (name, position):
  all but the first of a name repeat.

Within a batch of texts later units and windows of a name are settled before
Spark sorts, so that a passage that very many documents share is sorted once per
batch. Groups are walked through as they come, never held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import spread, staged, text_or_empty

THRESHOLD = 100
_TOGETHER = 1 << 22  # bytes named together
_PLACE = np.uint64((1 << 24) - 1)

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def core_size(threshold: int) -> int:
    """The largest power of two that is at most half the threshold."""
    return 1 << (threshold // 2).bit_length() - 1


def names(data: np.ndarray, size: int) -> np.ndarray:
    """Names of all strings of ``size`` bytes (a power of two), by doubling."""
    name = _mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)[data]
    length = 1
    while length < size:
        if len(name) <= length:
            return name[:0]
        left = name[:-length] * _M1
        left ^= left >> np.uint64(29)
        left += name[length:]
        left *= _GOLD
        name = left
        length *= 2
    return name


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mix(a * _GOLD + b)


def _cover(name: np.ndarray, core: int, begin: np.ndarray, length: np.ndarray | int, longest: int) -> np.ndarray:
    """Names of the strings at ``begin``, from those of ``2 * core`` bytes that cover them."""
    last = begin + length - 2 * core
    out = begin.astype(np.uint64) * np.uint64(0) + np.uint64(1)
    for i in range(-(-longest // (2 * core))):
        at = np.minimum(begin + 2 * core * i, last)
        out = _pair(out, _pair(name[at], name[at + core]))
    return out


def units(data: np.ndarray, ends: np.ndarray, threshold: int) -> tuple[np.ndarray, ...]:
    """begin, windows, core name, unit name of the units of documents that lie end to end."""
    core = core_size(threshold)
    reach = threshold - core  # anchors lie at most so far behind a window's start
    none = np.zeros(0, np.int64)
    if len(data) < threshold:
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    name = names(data, core)
    rank = (_mix(name) & ~_PLACE) | np.arange(len(name), dtype=np.uint64)
    least, size = rank, 1
    while 2 * size <= reach + 1:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < reach + 1:
        more = reach + 1 - size
        least = np.minimum(least[:-more], least[more:])
    anchor = (least & _PLACE).astype(np.int64)
    valid = np.ones(len(anchor), bool)
    for end in ends[:-1].tolist():
        valid[max(0, end - threshold + 1) : end] = False
    at = np.flatnonzero(valid)
    if not len(at):
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    new = np.ones(len(at), bool)
    new[1:] = (anchor[at[1:]] != anchor[at[:-1]]) | (np.diff(at) > 1)
    first = np.flatnonzero(new)
    begin = at[first]
    windows = np.diff(np.append(first, len(at)))
    where = anchor[begin]
    whole = _cover(name, core, begin, windows - 1 + threshold, reach + threshold)
    return begin, windows, _mix(name[where]), _pair(whole, (where - begin).astype(np.uint64) << np.uint64(8) | windows.astype(np.uint64))


def _keys(core: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """48 bits of the core's name and 64 of the other, in two numbers."""
    high = (core & ~np.uint64(0xFFFF)) | (name >> np.uint64(48))
    return high.view(np.int64), (name & np.uint64((1 << 48) - 1)).view(np.int64)


def _pieces(texts: Iterable[tuple[int, bytes]], overlap: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Keys, offsets and bytes of documents to be named together; long ones in overlapping slices."""
    keys, offsets, parts, size = [], [], [], 0
    for key, data in texts:
        for first in range(0, max(1, len(data) - overlap), _TOGETHER):
            part = data[first : first + _TOGETHER + overlap]
            if size and size + len(part) > _TOGETHER + overlap:
                yield keys, offsets, parts
                keys, offsets, parts, size = [], [], [], 0
            keys.append(key)
            offsets.append(first)
            parts.append(part)
            size += len(part)
    if parts:
        yield keys, offsets, parts


UNITS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("windows", pa.int32())])
_UNITS = "k1 long, k2 long, doc long, at long, windows int"
#: k2 of a row that is settled: it repeats.
SETTLED = -1


def _settle(k1: np.ndarray, k2: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The order by key and place, and which rows are not the first of their key."""
    order = np.lexsort((at, doc, k2, k1))
    again = np.zeros(len(order), bool)
    again[1:] = (k1[order[1:]] == k1[order[:-1]]) & (k2[order[1:]] == k2[order[:-1]])
    later = np.zeros(len(order), bool)
    later[order[again]] = True
    return later


def _batch(columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, UNITS, strict=True)], schema=UNITS)


def _settled(found: list[list[np.ndarray]]) -> pa.RecordBatch:
    k1, k2, doc, at, windows = (np.concatenate(c) for c in zip(*found, strict=True))
    later = _settle(k1, k2, doc, at)
    # Settled rows need no meeting place: spread them.
    k1 = np.where(later, _mix(at.astype(np.uint64) + doc.astype(np.uint64) * _GOLD).view(np.int64), k1)
    return _batch([k1, np.where(later, SETTLED, k2), doc, at, windows])


def _units_of(threshold: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            texts = ((d.as_py(), t.as_py()) for d, t in zip(batch.column(0), batch.column(1), strict=True))
            for keys, offsets, parts in _pieces(texts, threshold - 1):
                sizes = np.array([len(p) for p in parts], np.int64)
                ends = np.cumsum(sizes)
                begin, windows, core, name = units(np.frombuffer(b"".join(parts), np.uint8), ends, threshold)
                of = np.searchsorted(ends, begin, side="right")
                at = begin - (ends - sizes)[of] + np.array(offsets, np.int64)[of]
                found.append([*_keys(core, name), np.array(keys, np.int64)[of], at, windows])
            if found:
                yield _settled(found)

    return run


def _windows_of(threshold: int) -> Callable:
    """The windows of the units in ``ats`` and ``counts`` of each text, named one by one."""
    core = core_size(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in zip(*(batch.column(c) for c in ("doc", "bytes", "units")), strict=True):
                doc, marks = row[0].as_py(), row[2].values
                data = np.frombuffer(row[1].as_buffer(), np.uint8)
                ats = marks.field("at").to_numpy()
                counts = marks.field("windows").to_numpy().astype(np.int64)
                keys = marks.field("k1").to_numpy().view(np.uint64)
                lengths = counts + threshold - 1
                ends = np.cumsum(lengths)
                place = np.arange(ends[-1]) + np.repeat(ats - (ends - lengths), lengths)
                name = names(data[place], core)
                count_ends = np.cumsum(counts)
                step = np.arange(count_ends[-1]) - np.repeat(count_ends - counts, counts)
                begin = np.repeat(ends - lengths, counts) + step
                whole = _cover(name, core, begin, threshold, threshold)
                found.append(
                    [
                        *_keys(np.repeat(keys, counts), whole),
                        np.full(len(begin), doc, np.int64),
                        np.repeat(ats, counts) + step,
                        np.ones(len(begin), np.int64),
                    ]
                )
            if found:
                yield _settled(found)

    return run


def _walk(units_too: bool) -> Callable:
    """Go through rows sorted by (k1, k2, doc, at): settled rows, and rows after the first of their keys.

    With ``units_too`` also, with the core in k2's place, the first rows of cores
    that have several names (k1 then holds the core).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = None  # keys of the row before
        first_row = None  # the first row of the core at hand, as long as it has one name
        for batch in batches:
            if not batch.num_rows:
                continue
            k1, k2, doc, at, windows = (c.to_numpy() for c in batch.columns)
            core = k1 >> 16
            done = k2 == SETTLED
            same = np.zeros(len(k1), bool)
            same[1:] = (k1[1:] == k1[:-1]) & (k2[1:] == k2[:-1])
            same[0] = last_key == (k1[0], k2[0])
            repeats = done | same
            out = [[k1[repeats], np.full(repeats.sum(), SETTLED), doc[repeats], at[repeats], windows[repeats]]]
            if units_too:
                # First rows of names, in order; those whose core has another name are looked into.
                heads = np.flatnonzero(~repeats)
                rows = [c[heads] for c in (core, doc, at, windows)]
                if first_row is not None:
                    rows = [np.concatenate(([f], c)) for f, c in zip(first_row[:4], rows, strict=True)]
                    told = first_row[4]
                else:
                    told = False
                n = len(rows[0])
                if n:
                    next_same = np.zeros(n, bool)
                    next_same[:-1] = rows[0][:-1] == rows[0][1:]
                    shared = next_same.copy()
                    shared[1:] |= next_same[:-1]
                    say = shared.copy()
                    if first_row is not None and told:
                        say[0] = False  # was said with the batch before
                    out.append([rows[0][say] << 16, np.zeros(say.sum(), np.int64), *(r[say] for r in rows[1:])])
                    # The last one waits for what comes next; remember whether it has been said.
                    was_told = bool(shared[-1]) or (n == 1 and first_row is not None and told)
                    first_row = (*(int(r[-1]) for r in rows), was_told)
            last_key = (k1[-1], k2[-1])
            yield _batch([np.concatenate(c) for c in zip(*out, strict=True)])

    return run


def _sorted(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows that share keys in one partition, all sorted by key and place."""
    return rows.repartition(*(F.expr(k) for k in keys)).sortWithinPartitions("k1", "k2", "doc", "at")


def _cut(threshold: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data, found in zip(batch.column("bytes"), batch.column("found"), strict=True):
                raw = data.as_py()
                cuts, kept, before = [], [], 0
                if found.is_valid and len(found.values):
                    begin = found.values.field("at").to_numpy()
                    end = begin + found.values.field("windows").to_numpy() + threshold - 1
                    order = np.argsort(begin, kind="stable")
                    begin, end = begin[order], np.maximum.accumulate(end[order])
                    new = np.ones(len(begin), bool)
                    new[1:] = begin[1:] > end[:-1]
                    first = np.flatnonzero(new)
                    last = np.append(first[1:], len(begin)) - 1
                    cuts = list(zip(begin[first].tolist(), end[last].tolist(), strict=True))
                for a, b in cuts:
                    kept.append(raw[before:a])
                    before = b
                kept.append(raw[before:])
                left = b"".join(kept)
                rows.append((len(raw), len(raw) - len(left), len(cuts), hashlib.sha256(left).hexdigest(), cuts, left))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            spans = pa.array([[{"begin": a, "end": b} for a, b in c] for c in columns[4]], SPANS)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(columns[i], pa.int64()) for i in range(3)),
                    pa.array(columns[3], pa.string()),
                    spans,
                    pa.array(columns[5], pa.binary()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"],
            )

    return run


SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def remove_repeats(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept: a row per row of ``docs``.

    ``docs`` needs doc_id (an integer) and text; other columns are ignored. Every
    byte goes that lies in a string of ``threshold`` bytes which also starts
    earlier: in a document of smaller id, or earlier in the same one. ``spans`` are
    the runs that go, ``kept`` the bytes that stay. Null texts count as empty.
    Null ids come before all others; rows that share an id follow each other in
    some order. An empty table gives an empty one.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("bytes"))
    ids = docs.select("doc_id")
    if ids.where("doc_id IS NULL").isEmpty() and ids.groupBy("doc_id").count().where("count > 1").isEmpty():
        texts = texts.withColumn("doc", F.col("doc_id"))
    else:
        texts = spread(texts, "doc_id").withColumnRenamed("row_id", "doc")

    named = texts.select("doc", "bytes").mapInArrow(_units_of(threshold), _UNITS)
    found = staged(_sorted(named, "k1 >> 16").mapInArrow(_walk(True), _UNITS), "units")
    unit = F.struct("k1", "at", "windows")
    open_units = found.where(F.col("k2") != SETTLED).groupBy("doc").agg(F.collect_list(unit).alias("units"))
    windows = texts.join(open_units, "doc").select("doc", "bytes", "units").mapInArrow(_windows_of(threshold), _UNITS)
    repeated = staged(_sorted(windows, "k1", "k2").mapInArrow(_walk(False), _UNITS), "windows")

    both = found.where(F.col("k2") == SETTLED).unionByName(repeated)
    by_doc = both.groupBy("doc").agg(F.collect_list(F.struct("at", "windows")).alias("found"))
    return (
        texts.join(by_doc, "doc", "left")
        .select("doc_id", "bytes", "found")
        .mapInArrow(
            _cut(threshold),
            "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
            "spans array<struct<begin: long, end: long>>, kept binary",
        )
    )
