"""Fixed-length training windows by sum-of-squares packing.

Every task packs the documents it reads, online and in one pass. Whole windows
are cut off first. What is left of a document goes to the fill level (or a new
window) that makes the sum of the squared numbers of partly filled windows per
level smallest; these numbers are kept in an array by level, next to a stack of
the windows at each level. When the task's documents are over, the windows that
are still open are filled up from the emptiest ones, whose pieces may be cut, so
that a task leaves one window unfilled at most. Nothing is shuffled, and a
task's memory holds its open windows, not its documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import lean_batches, staged
from tagloom.llm.encoding import Encoder, give_back

WINDOW = 1024
END_ID = 0
_ROWS = 20_000
#: What a task may keep and take together for encoding; it holds little else.
ENCODER_WORDS = 400_000
ENCODER_CHARACTERS = 12_000_000

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("part", pa.int64()),
    ]
)

Piece = tuple  # (doc_id, tokens of its document, first token, ids)


class Windows:
    """Windows of one task, by how far they are filled."""

    def __init__(self, size: int):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)  # the last one stays 0: filled windows do not count
        self.open: list[list[list[Piece]]] = [[] for _ in range(size)]

    def level_for(self, length: int) -> int:
        """The level to put ``length`` tokens on; 0 is a new window. Of equal ones the fullest."""
        n = self.count
        last = self.size - length
        change = 2 * (n[length : self.size + 1] - n[: last + 1]) + 2
        change[0] = 2 * n[length] + 1
        change[last] -= 1 if last else 0
        change[1:][n[1 : last + 1] == 0] = np.iinfo(np.int64).max
        return last - int(np.argmin(change[::-1]))

    def put(self, piece: Piece) -> list[Piece] | None:
        """Place a piece shorter than a window; the pieces of a window that it fills."""
        level = self.level_for(len(piece[3]))
        window = []
        if level:
            window = self.open[level].pop()
            self.count[level] -= 1
        window.append(piece)
        level += len(piece[3])
        if level == self.size:
            return window
        self.open[level].append(window)
        self.count[level] += 1
        return None

    def close(self) -> Iterator[list[Piece]]:
        """Fill the open windows, fullest first, from the emptiest; one stays unfilled at most."""
        rest = [(level, w) for level, windows in enumerate(self.open) for w in windows]
        first = 0  # windows before it are used up
        while first < len(rest):
            level, window = rest.pop()
            while level < self.size and first < len(rest):
                donor_level, donor = rest[first]
                doc, tokens, start, ids = donor.pop()
                take = min(len(ids), self.size - level)
                window.append((doc, tokens, start, ids[:take]))
                if take < len(ids):
                    donor.append((doc, tokens, start + take, ids[take:]))
                level += take
                rest[first] = (donor_level - take, donor)
                first += not donor
            yield window


def _pack(batches: Iterator[pa.RecordBatch], path: str, size: int, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder = Encoder.of(path, ENCODER_WORDS, ENCODER_CHARACTERS)
    windows = Windows(size)
    end = np.array([end_id], "<u4")
    part = TaskContext.get().partitionId()
    rows: list[tuple] = []
    sequence = 0

    def emit(window: list[Piece]) -> None:
        nonlocal sequence
        offset = 0
        for doc, tokens, start, ids in window:
            rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), tokens, sequence, offset, part))
            offset += len(ids)
        sequence += 1

    def flush() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * len(PIECES)
        rows.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, PIECES, strict=True)], schema=PIECES
        )

    for batch in batches:
        docs = batch.column(0).to_pylist()
        for doc, ids in zip(docs, encoder.encode(t.as_py() for t in batch.column(1)), strict=True):
            ids = np.concatenate((ids, end))
            whole = len(ids) - len(ids) % size
            for start in range(0, whole, size):
                emit([(doc, len(ids), start, ids[start : start + size])])
            if whole < len(ids):
                # A copy, so that the ids of the whole document can go.
                filled = windows.put((doc, len(ids), whole, ids[whole:].copy()))
                if filled:
                    emit(filled)
            if len(rows) >= _ROWS:
                yield flush()
    for window in windows.close():
        emit(window)
        if len(rows) >= _ROWS:
            yield flush()
    yield flush()
    give_back()


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: a row per piece.

    ``docs`` needs doc_id (an integer) and text; other columns are ignored. A
    document is its ids and ``end_id`` (null text: that alone), so every row of
    ``docs`` is packed, repeated rows each for itself. ``sequence_id`` counts the
    windows without gaps. An empty table gives an empty one.
    """
    lean_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = ", ".join(f"{f.name} long" for f in PIECES)
    pieces = rows.mapInArrow(lambda batches: _pack(batches, tokenizer, window, end_id), schema)
    pieces = staged(pieces, "pieces")
    # A row per task, not per document.
    tasks = pieces.groupBy("part").agg((F.max("sequence_id") + 1).alias("sequences"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = tasks.select("part", F.coalesce(F.sum("sequences").over(before), F.lit(0)).alias("base"))
    return (
        pieces.join(bases, "part")
        .withColumn("sequence_id", F.col("sequence_id") + F.col("base"))
        .select(*(f.name for f in PIECES if f.name != "part"))
    )
