"""Token ids in binary files of patched frame-of-reference blocks.

Documents are dealt out in ranges of ascending doc_id; each range becomes one
file, a row of segments, each with a line feed behind it. A segment holds whole
documents (numbers are little-endian):

=============  ==================================================
magic          ``PFR1``
header         u32 shard, u32 segment, u32 documents, u32 blocks,
               u64 ids, u64 bytes of the body
documents      i64 doc_id, u8 1 if the doc_id is null, u64 ids of each, one column after the other
index          u64 start of each block in the body, and its end
body           the blocks
=============  ==================================================

A block holds ``BLOCK`` ids (the last one may be filled up): u32 minimum, u8
width, u16 exceptions; then, for each 64 ids, ``width`` words of 64 bits with
the ids less the minimum, of which bits beyond the width are cut off; then u16
places and u32 whole differences of the exceptions. The width is what the
``PERCENTILE`` smallest difference needs, so a few large ones do not widen a
block. The index makes any id reachable without the blocks before it.

Spark writes the files (with its text writer, which passes bytes through) and
reads them (as binary files), so they may lie in any store, and a lost task
leaves nothing half written.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.llm.common import lean_batches
from tagloom.llm.encoding import Encoder, give_back
from tagloom.sources.tables import fresh_dir

BLOCK = 256
PERCENTILE = 0.9
END_ID = 2
#: A segment ends with the document that brings it to so many ids.
SEGMENT = 1_000_000

_MAGIC = b"PFR1"
_HEADER = "<4sIIIIQQ"
_BLOCK = np.dtype([("least", "<u4"), ("width", "u1"), ("exceptions", "<u2")])


def _pack_words(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 64 differences as rows of ``width`` words, the lowest bits of each."""
    words = np.zeros((width, len(values)), "<u8")
    values = np.ascontiguousarray(values.T) & np.uint64((1 << width) - 1)  # one place of all rows in a piece
    for i in range(64):
        word, shift = divmod(i * width, 64)
        words[word] |= values[i] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= values[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T)


def _unpack_words(words: np.ndarray, width: int) -> np.ndarray:
    words = np.ascontiguousarray(words.T)
    values = np.empty((64, words.shape[1]), "<u4")
    cut = np.uint64((1 << width) - 1)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        value = words[word] >> np.uint64(shift)
        if shift + width > 64:
            value |= words[word + 1] << np.uint64(64 - shift)
        values[i] = value & cut
    return values.T


def _bit_length(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1]


def pack_blocks(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """The index and the body of a segment."""
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return np.zeros(1, "<u8"), b""
    rows = np.pad(ids, (0, blocks * BLOCK - len(ids)), mode="edge").reshape(blocks, BLOCK)
    least = rows.min(axis=1)
    over = (rows - least[:, None]).astype("<u8")
    rank = min(BLOCK - 1, int(PERCENTILE * BLOCK))
    widths = _bit_length(np.partition(over, rank, axis=1)[:, rank])
    outside = (over >> widths[:, None].astype("<u8")) != 0
    heads = np.zeros(blocks, _BLOCK)
    heads["least"], heads["width"], heads["exceptions"] = least, widths, outside.sum(axis=1)
    packed: list[bytes] = [b""] * blocks
    for width in np.unique(widths[widths > 0]).tolist():
        at = np.flatnonzero(widths == width)
        words = _pack_words(over[at].reshape(-1, 64), width).reshape(len(at), -1)
        for i, row in zip(at.tolist(), words, strict=True):
            packed[i] = row.tobytes()
    block_of, places = np.nonzero(outside)
    # Slices of bytes are cheaper than those of arrays, and there are three per block.
    head, place, value = heads.tobytes(), places.astype("<u2").tobytes(), over[outside].astype("<u4").tobytes()
    ends = np.cumsum(heads["exceptions"], dtype=np.int64)
    parts, begin, wide = [], 0, _BLOCK.itemsize
    for i, end in enumerate(ends.tolist()):
        parts += (head[wide * i : wide * (i + 1)], packed[i], place[2 * begin : 2 * end], value[4 * begin : 4 * end])
        begin = end
    sizes = wide + BLOCK // 8 * widths.astype(np.int64) + 6 * heads["exceptions"].astype(np.int64)
    return np.concatenate(([0], np.cumsum(sizes))).astype("<u8"), b"".join(parts)


def unpack_blocks(index: np.ndarray, body: bytes, first: int, last: int) -> np.ndarray:
    """The ids of the blocks ``first`` to ``last`` (without it); no other block is touched."""
    data = np.frombuffer(body, np.uint8)
    starts = index[first:last].astype(np.int64)
    heads = data[starts[:, None] + np.arange(_BLOCK.itemsize)].copy().view(_BLOCK).ravel()
    out = np.zeros((last - first, BLOCK), "<u4")
    for width in np.unique(heads["width"]).tolist():
        at = np.flatnonzero(heads["width"] == width)
        size = BLOCK // 8 * width
        words = data[starts[at][:, None] + _BLOCK.itemsize + np.arange(size)].view("<u8")
        out[at] = _unpack_words(words.reshape(-1, width), width).reshape(len(at), BLOCK) if width else 0
    for i in np.flatnonzero(heads["exceptions"]).tolist():
        n = int(heads["exceptions"][i])
        begin = int(starts[i]) + _BLOCK.itemsize + BLOCK // 8 * int(heads["width"][i])
        places = np.frombuffer(body, "<u2", n, begin)
        out[i, places] = np.frombuffer(body, "<u4", n, begin + 2 * n)
    out += heads["least"][:, None]
    return out.ravel()


class Segment:
    """One segment of a file, read from its bytes at ``at``."""

    def __init__(self, content: bytes, at: int = 0):
        magic, self.shard, self.number, docs, blocks, self.ids, size = struct.unpack_from(_HEADER, content, at)
        if magic != _MAGIC:
            raise ValueError(f"no segment at byte {at}")
        at += struct.calcsize(_HEADER)
        self.doc_ids = np.frombuffer(content, "<i8", docs, at)
        self.nulls = np.frombuffer(content, np.uint8, docs, at + 8 * docs)
        self.lengths = np.frombuffer(content, "<u8", docs, at + 9 * docs).astype(np.int64)
        at += 17 * docs
        self.index = np.frombuffer(content, "<u8", blocks + 1, at)
        at += 8 * (blocks + 1)
        self.body = memoryview(content)[at : at + size]
        self.end = at + size + 1  # the line feed

    def read(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from the id ``start`` of the segment on, fewer at its end."""
        count = min(count, self.ids - start)
        first, last = start // BLOCK, -(-(start + count) // BLOCK)
        return unpack_blocks(self.index, self.body, first, last)[start - first * BLOCK :][:count]


def segments(content: bytes) -> Iterator[Segment]:
    at = 0
    while at < len(content):
        segment = Segment(content, at)
        yield segment
        at = segment.end


def write_segment(shard: int, number: int, docs: list[tuple[int | None, np.ndarray]]) -> bytes:
    ids = np.concatenate([i for _, i in docs]).astype("<u4")
    index, body = pack_blocks(ids)
    return b"".join(
        (
            struct.pack(_HEADER, _MAGIC, shard, number, len(docs), len(index) - 1, len(ids), len(body)),
            np.array([d or 0 for d, _ in docs], "<i8").tobytes(),
            np.array([d is None for d, _ in docs], np.uint8).tobytes(),
            np.array([len(i) for _, i in docs], "<u8").tobytes(),
            index.tobytes(),
            body,
        )
    )


def _write(batches: Iterable[pa.RecordBatch], tokenizer: str, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder = Encoder.of(tokenizer)
    shard = TaskContext.get().partitionId()
    end = np.array([end_id], "<u4")
    docs: list[tuple[int | None, np.ndarray]] = []
    size = number = 0

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([write_segment(shard, number, docs)], pa.binary())], ["segment"])

    for batch in batches:
        for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode(t.as_py() for t in batch.column(1)), strict=True):
            docs.append((doc, np.concatenate((ids, end))))
            size += len(ids) + 1
            if size >= SEGMENT:
                yield row()
                docs, size, number = [], 0, number + 1
    if docs:
        yield row()
    give_back()


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Write the ids of all documents to files below ``path``, in ascending order of doc_id.

    ``docs`` needs doc_id (an integer) and text. Null ids come first, repeated ids
    follow each other in any order. Null and empty texts give ``end_id`` alone. An
    empty table gives files without segments.
    """
    lean_batches(docs.sparkSession)
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id")
    )
    rows = ordered.mapInArrow(lambda batches: _write(batches, tokenizer, end_id), "segment binary")
    rows.select(F.col("segment").cast("string")).write.option("compression", "none").text(path)


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            before = 0
            for s in segments(content.as_py()):
                ids = s.read(0, s.ids)
                ends = np.cumsum(s.lengths)
                starts = ends - s.lengths
                data = ids.astype("<u4", copy=False)
                crcs = [zlib.crc32(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(s.doc_ids.astype(np.int64), mask=s.nulls.astype(bool)),
                        pa.array(np.full(len(crcs), s.shard, np.int64)),
                        pa.array(starts + before),
                        pa.array(s.lengths),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["doc_id", "shard", "start", "n_tokens", "ids_crc32"],
                )
                before += s.ids
    give_back()


def _totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [(s.shard, s.ids) for content in batch.column(0) for s in segments(content.as_py())]
        columns = list(zip(*found, strict=True)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["shard", "ids"])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32: what the files below ``path`` hold, a row per document."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("content")
    docs = files.mapInArrow(_read, "doc_id long, shard long, start long, n_tokens long, ids_crc32 long")
    # A row per file, not per document, from the headers.
    shards = files.mapInArrow(_totals, "shard long, ids long").groupBy("shard").agg(F.sum("ids").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return docs.join(bases, "shard").select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"
    )


def id_files(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the ids to a new folder in the shared one and read them back."""
    path = fresh_dir(docs.sparkSession, "ids")
    write_ids(docs, path, tokenizer, end_id)
    return read_ids(docs.sparkSession, path)
