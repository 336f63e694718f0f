"""Benchmark decontamination: a broadcast set of benchmark windows, scanned for in every text.

Texts and benchmark items are lower-cased (A-Z only) and cut into words. Every
item gives its windows of ``WINDOW`` consecutive words (an item with fewer words,
but some, is one window). The windows go to the executors as a hash set, in
blocks of at most ``BLOCK_BYTES`` (the benchmark is a stated query set, so a
larger one is scanned for block by block, never joined pair by pair). A task
hashes the windows of its texts at every position, looks the hashes up in the set,
and verifies each hit against the window's own words before it counts. Words of
a text inside any verified occurrence are hit.

Then either the contaminated documents go, or their hit spans are cut out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import lean_batches, staged

WINDOW = 10
BLOCK_BYTES = 32 << 20

# Fixed values of the contract: words are runs of digits, lower-case ASCII letters and all non-ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_PATTERN = re.compile(WORD)
_LOWER = str.maketrans(UPPER, LOWER)
# Odd multipliers of the window hash, one per position in a window.
_MULTIPLIERS = np.array([(0x9E3779B97F4A7C15 * (2 * k + 1)) & (2**64 - 1) | 1 for k in range(WINDOW)], dtype=np.uint64)


def words_of(text: str | None) -> list[str]:
    """The words of a text, A-Z lower-cased; none for null."""
    return _PATTERN.findall(text.translate(_LOWER)) if text else []


def item_words(text: str = "text") -> Column:
    """The same words as :func:`words_of`, in Spark."""
    return F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), F.lit(WORD), 0)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id, words: each distinct window of each item; items without words give none."""
    words = item_words()
    starts = F.sequence(F.lit(0), F.greatest(F.size("_w") - window, F.lit(0)))
    return (
        benchmark.select("item_id", words.alias("_w"))
        .where(F.size("_w") > 0)
        .select("item_id", F.explode(F.transform(starts, lambda i: F.slice("_w", i + 1, window))).alias("words"))
        .distinct()
    )


# Bytes that are part of words once A-Z is lowered: digits, a-z and every byte of a non-ASCII character.
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[0x30:0x3A] = _IN_WORD[0x61:0x7B] = _IN_WORD[0x80:] = True
_CHUNK_BYTES = 1 << 20


def _powers(n: int) -> np.ndarray:
    """Odd multipliers for the bytes of a word, by place in it."""
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(max(n, 1), 0x100000001B3, dtype=np.uint64)) | np.uint64(1)


def _word_places(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lowered bytes, which of them are in words, and [first, end) byte of every word; words end where a text does."""
    lowered = data + np.where((data >= 0x41) & (data <= 0x5A), 32, 0).astype(np.uint8)
    inside = _IN_WORD[lowered]
    opens = np.zeros(len(data) + 1, dtype=bool)
    opens[starts] = True
    opens[0] = opens[len(data)] = True
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    first = np.flatnonzero(inside & (~before | opens[:-1]))
    end = np.flatnonzero(inside & (~after | opens[1:])) + 1
    return lowered, inside, first, end


def _word_hashes(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, given the bytes of all words one after the other (equal words, equal hashes)."""
    if len(lengths) == 0:
        return np.zeros(0, dtype=np.uint64)
    at = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    place = np.arange(len(values)) - np.repeat(at, lengths)
    with np.errstate(over="ignore"):
        h = np.add.reduceat(values.astype(np.uint64) * _powers(int(lengths.max()))[place], at)
        return h ^ (lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _table(rows: list) -> tuple[np.ndarray, np.ndarray, dict, dict]:
    """Sorted word hashes with their ids, window hashes by length, item ids by window (a tuple of words)."""
    items: dict[tuple, set] = {}
    for r in rows:
        of = items.setdefault(tuple(r.words), set())
        if r.item_id is not None:
            of.add(r.item_id)
    words = sorted({w for key in items for w in key})
    data = np.frombuffer("".join(words).encode(), dtype=np.uint8)
    sizes = np.array([len(w.encode()) for w in words], dtype=np.int64)
    hashes = _word_hashes(data, sizes)
    order = np.argsort(hashes, kind="stable")
    sorted_hashes = hashes[order]
    # Words of equal hash share an id; verification tells them apart.
    ids_sorted = np.searchsorted(sorted_hashes, sorted_hashes).astype(np.int64)
    id_of = dict(zip(words, ids_sorted[np.argsort(order)].tolist()))
    windows: dict[int, list] = {}
    for key in items:
        ids = np.array([id_of[w] for w in key], dtype=np.int64)
        windows.setdefault(len(key), []).append(_hash(ids, len(key))[0])
    return sorted_hashes, ids_sorted, {n: np.unique(np.array(h, dtype=np.uint64)) for n, h in windows.items()}, items


def _hash(ids: np.ndarray, length: int) -> np.ndarray:
    """Hash of the window of ``length`` ids at each start."""
    n = len(ids) - length + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    if n > 0:
        values = ids.astype(np.uint64)
        with np.errstate(over="ignore"):
            for k in range(length):
                out += values[k : k + n] * _MULTIPLIERS[k]
    return out


def scan_texts(texts: list, table: tuple) -> list[tuple[int, list, set]]:
    """Per text: number of words, merged hit spans [start, end) by word, and item ids found.

    All texts of a chunk go through NumPy together: bytes are classed and
    lowered, words hashed, looked up among the benchmark's words, and windows
    of ids hashed and looked up among the benchmark's windows. Each hit is then
    verified on the words themselves.
    """
    vocab, vocab_ids, windows, items = table
    encoded = [(t or "").encode() for t in texts]
    sizes = np.array([len(e) for e in encoded], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    data = np.frombuffer(b"".join(encoded), dtype=np.uint8)
    lowered, inside, first, end = _word_places(data, starts)
    doc = np.searchsorted(starts, first, side="right") - 1
    counts = np.bincount(doc, minlength=len(texts))
    h = _word_hashes(lowered[inside], end - first)
    at = np.minimum(np.searchsorted(vocab, h), max(len(vocab) - 1, 0))
    known = (vocab[at] == h) if len(vocab) else np.zeros(len(h), dtype=bool)
    ids = np.where(known, vocab_ids[at] if len(vocab) else 0, -1)
    unknown = np.concatenate([[0], np.cumsum(ids < 0)])
    hit = np.zeros(len(ids) + 1, dtype=np.int32)
    found: dict[int, set] = {}
    for length, table_hashes in windows.items():
        if len(ids) < length:
            continue
        places = np.flatnonzero(np.isin(_hash(np.maximum(ids, 0), length), table_hashes))
        places = places[(unknown[places + length] == unknown[places]) & (doc[places] == doc[places + length - 1])]
        for i in places.tolist():
            key = tuple(lowered[first[j] : end[j]].tobytes().decode() for j in range(i, i + length))
            of = items.get(key)
            if of is not None:  # verified on the words themselves
                hit[i] += 1
                hit[i + length] -= 1
                found.setdefault(int(doc[i]), set()).update(of)
    covered = np.cumsum(hit)[:-1] > 0
    n_hit = np.bincount(doc[covered], minlength=len(texts)) if len(doc) else np.zeros(len(texts), dtype=np.int64)
    base = np.concatenate([[0], np.cumsum(counts)])
    out = []
    for d in range(len(texts)):
        spans = []
        if n_hit[d]:
            mine = covered[base[d] : base[d + 1]].astype(np.int8)
            edges = np.flatnonzero(np.diff(np.concatenate([[0], mine, [0]])))
            spans = edges.reshape(-1, 2).tolist()
        out.append((int(counts[d]), spans, found.get(d, set())))
    return out


def _scanner(table: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            out, chunk, size = [], [], 0
            for t in texts:
                chunk.append(t)
                size += len(t or "")
                if size >= _CHUNK_BYTES:
                    out += scan_texts(chunk, table)
                    chunk, size = [], 0
            out += scan_texts(chunk, table) if chunk else []
            yield pa.RecordBatch.from_pydict(
                {
                    "_row": batch.column("_row"),
                    "_doc": batch.column("_doc"),
                    "n_words": pa.array([n for n, _, _ in out], pa.int64()),
                    "spans": pa.array([s for _, s, _ in out], pa.list_(pa.list_(pa.int64()))),
                    "items": pa.array([sorted(f) for _, _, f in out], pa.list_(pa.int64())),
                }
            )

    return run


_HIT_SCHEMA = "n_words long, spans array<array<long>>, items array<long>"


def _hit_words(spans: Column) -> Column:
    """Words covered by a list of [start, end) spans that may overlap."""
    ordered = F.array_sort(spans)
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("end"))
    merged = F.aggregate(
        ordered,
        start,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(s[1] - F.greatest(s[0], acc["end"]), F.lit(0))).alias("n"),
            F.greatest(acc["end"], s[1]).alias("end"),
        ),
    )
    return merged["n"]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keyed: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, items, spans (and ``_row``).

    ``items`` lists the distinct non-null item_ids with a window that occurs in
    the text; ``spans`` the maximal runs [start, end) of hit words. Null and empty
    texts have no words and no hit; items without words give no window; items
    with null ids still hit words but are not listed. Repeated rows and ids are
    scanned each on their own. Texts are read whole, however long; an empty
    table gives an empty one, an empty benchmark no hit. Other columns of
    ``docs`` are not read. With ``keyed``, ``docs`` already has a unique ``_row``.
    """
    lean_batches(docs.sparkSession)
    if not keyed:
        docs = docs.withColumn("_row", F.monotonically_increasing_id())
    windows = benchmark_windows(benchmark, window).withColumn(
        "_bytes", F.aggregate("words", F.lit(0).cast("long"), lambda acc, w: acc + F.octet_length(w) + 8)
    )
    windows = staged(windows, "windows")
    total = windows.agg(F.sum("_bytes")).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    texts = docs.select("_row", F.col("doc_id").alias("_doc"), "text")
    if blocks > 1 and not keyed:
        texts = staged(texts, "texts")  # the same rows for each block
    schema = f"_row long, _doc {docs.schema['doc_id'].dataType.simpleString()}, " + _HIT_SCHEMA
    found = []
    for b in range(blocks):
        part = windows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b).select("item_id", "words")
        found.append(texts.mapInArrow(_scanner(_table(part.collect())), schema))
    hits = found[0]
    if blocks > 1:
        for more in found[1:]:
            hits = hits.unionByName(more)
        hits = hits.groupBy("_row").agg(
            F.first("_doc").alias("_doc"),
            F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
    return hits.select("_row", F.col("_doc").alias("doc_id"), "n_words", _hit_words(F.col("spans")).alias("n_hit"), "items", "spans")


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row per row of ``docs``.

    ``items_sha256`` is the sha256 (lowercase hex) of the listed item_ids as
    text, sorted as text and joined by commas (of the empty text if none).
    """
    found = contamination(docs, benchmark, window)
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.col("n_hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the characters from the first to the last word of each hit span."""
    for batch in batches:
        out = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            if not spans:
                out.append(text)
                continue
            places = [m.span() for m in _PATTERN.finditer(text.translate(_LOWER))]
            kept, at = [], 0
            for start, end in spans:
                kept.append(text[at : places[start][0]])
                at = places[end - 1][1]
            kept.append(text[at:])
            out.append("".join(kept))
        yield pa.RecordBatch.from_pydict({"_row": batch.column("_row"), "text": pa.array(out, pa.string())})


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW) -> DataFrame:
    """``docs`` without benchmark text, columns as they were.

    ``remove="documents"`` drops every contaminated row; ``"spans"`` keeps all
    rows and cuts each run of hit words out of the text (from the first
    character of its first word to the last of its last; text between runs stays).
    Null texts stay null. An empty table gives an empty one.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is documents or spans, not {remove}")
    rows = staged(docs.select(F.monotonically_increasing_id().alias("_row"), F.struct("*").alias("_all")), "texts")
    keyed = rows.select("_row", "_all.doc_id", "_all.text")
    found = staged(contamination(keyed, benchmark, window, keyed=True).where("n_hit > 0"), "hits")
    if remove == "documents":
        return rows.join(found, "_row", "left_anti").select("_all.*")
    cut = rows.join(found.select("_row", "spans"), "_row").select("_row", F.col("_all.text").alias("text"), "spans")
    cut = cut.mapInArrow(_cut, "_row long, text string").withColumnRenamed("text", "_text")
    cleaned = rows.join(cut, "_row", "left")
    return cleaned.select(
        *(
            F.coalesce("_text", F.col("_all.text")).alias("text") if c == "text" else F.col(f"_all.{c}").alias(c)
            for c in docs.columns
        )
    )


def items_digest(ids: list) -> str:
    return hashlib.sha256(",".join(sorted(str(i) for i in ids)).encode()).hexdigest()
