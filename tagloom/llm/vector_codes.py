"""Vector codes: product quantisation whose nearest entries come from an equal-average search.

A vector of integers is cut into ``parts`` equal consecutive parts; each part
position has its own codebook. The nearest entry of a part is searched among
the entries sorted by the sum of their components: starting at the part's own
sum, the search goes outward on both sides and stops a side as soon as
``gap * gap > best * width`` (gap: difference of sums, width: components of a
part), which no entry beyond can beat, since ``|x - c|^2 >= (sum x - sum c)^2 / width``.
On equal distances the lower index wins, which is why a side stops only when the
bound strictly exceeds the best distance.

Spark does the work: vectors are staged once as integers; each round assigns
their parts inside tasks (NumPy over Arrow batches) with the codebook shipped in
the closure (``parts * entries * width`` integers, not growing with the rows),
and each task sums the components per (part, entry) before the shuffle, so a
round shuffles at most ``parts * entries * width`` rows a task. The driver
receives those sums only, which have the same bound.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import staged

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
# Components with |x| at or beyond this would not keep squared distances (times the width) within 64 bits.
LARGEST = float(1 << 12)


def integer_vectors(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is whole and finite, with ``_id`` (vec_id) and ``v``: ``floor(256 * x)`` per component.

    A vector is kept if it is not null, has no null, NaN or infinite component
    and none of magnitude ``2**12`` or more (squared distances times a width of
    up to 256 then fit in 64 bits). Of those, only vectors whose length is a positive multiple of
    ``PARTS`` count, and of these only those as long as the one of the smallest
    id (ids ascending, null last; then the vector): one codebook has one width.
    """
    finite = F.forall(
        column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(LARGEST))
    )
    ints = F.transform(column, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    rows = embeddings.where(F.col(column).isNotNull() & finite).select(
        "*", F.col("vec_id").alias("_id"), ints.alias("v")
    )
    return rows.where((F.size("v") > 0) & (F.size("v") % PARTS == 0))


def _first_entries(rows: DataFrame, entries: int) -> np.ndarray:
    """The starting codebooks: parts of the ``entries`` smallest ids, shape (parts, entries, width)."""
    smallest = [F.asc_nulls_last("_id"), "v"]
    size = rows.orderBy(*smallest).select(F.size("v")).first()[0]
    first = rows.where(F.size("v") == size).orderBy(*smallest).limit(entries).collect()
    width = size // PARTS
    same = [r.v for r in first]
    return np.array(same, dtype=np.int64).reshape(len(same), PARTS, width).transpose(1, 0, 2).copy()


def nearest(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry of ``book`` (k, w) for each of ``points`` (n, w).

    Equal-average search: entries sorted by their sums, each point's search
    goes outward from its own sum on both sides, a side ends once the squared
    gap of sums over the width strictly exceeds the best distance. Ties go to
    the lower index. All arithmetic is on 64-bit integers.
    """
    n, width = points.shape
    k = len(book)
    sums = book.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sorted_sums, sorted_book = sums[order], book[order]
    own = points.sum(axis=1)
    start = np.searchsorted(sorted_sums, own)
    best = np.full(n, np.iinfo(np.int64).max, dtype=np.int64)
    index = np.full(n, k, dtype=np.int64)
    for step, side in ((-1, start - 1), (1, start)):
        at = side.copy()
        open_ = (at >= 0) & (at < k)
        while open_.any():
            rows = np.nonzero(open_)[0]
            where = at[rows]
            gap = own[rows] - sorted_sums[where]
            beyond = (index[rows] < k) & (gap * gap > best[rows] * width)
            rows, where = rows[~beyond], where[~beyond]
            open_[np.nonzero(open_)[0][beyond]] = False
            if len(rows):
                diff = points[rows] - sorted_book[where]
                dist = (diff * diff).sum(axis=1)
                entry = order[where]
                better = (dist < best[rows]) | ((dist == best[rows]) & (entry < index[rows]))
                best[rows[better]] = dist[better]
                index[rows[better]] = entry[better]
                at[rows] += step
                open_[rows] = (at[rows] >= 0) & (at[rows] < k)
    return index, best


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    v = batch.column("v")
    values = v.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return values.reshape(len(batch), PARTS, width)


def _sums(books: np.ndarray):
    """Per task: component sums and counts of the parts assigned to each entry."""
    parts, k, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, k, width), dtype=np.int64)
        count = np.zeros((parts, k), dtype=np.int64)
        for batch in batches:
            if len(batch) == 0:
                continue
            vectors = _matrix(batch, width)
            for p in range(parts):
                index, _ = nearest(vectors[:, p, :], books[p])
                np.add.at(total[p], index, vectors[:, p, :])
                count[p] += np.bincount(index, minlength=k)
        p_idx, e_idx = np.nonzero(count)
        if len(p_idx):
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(p_idx, pa.int32()),
                    "entry": pa.array(e_idx, pa.int32()),
                    "n": pa.array(count[p_idx, e_idx], pa.int64()),
                    "total": pa.array(list(total[p_idx, e_idx]), pa.list_(pa.int64())),
                }
            )

    return run


def _codes(books: np.ndarray):
    """Per row: the entry of each part and the summed squared distance."""
    parts, k, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch, width)
            codes = np.zeros((len(batch), parts), dtype=np.int64)
            error = np.zeros(len(batch), dtype=np.int64)
            for p in range(parts):
                codes[:, p], dist = nearest(vectors[:, p, :], books[p])
                error += dist
            text = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
            yield pa.RecordBatch.from_pydict(
                {"_row": batch.column("_row"), "code": pa.array(text, pa.string()), "error": pa.array(error, pa.int64())}
            )

    return run


def _updated(books: np.ndarray, sums: list) -> np.ndarray:
    """Each used entry becomes the componentwise floor of sum over count; unused ones stay."""
    out = books.copy()
    for r in sums:
        out[r.part, r.entry] = np.floor_divide(np.array(r.total, dtype=np.int64), r.n)
    return out


def digest(books: np.ndarray) -> str:
    """sha256 of all entries' components by part, entry and position, ``,``-joined."""
    return hashlib.sha256(",".join(str(int(x)) for x in books.reshape(-1)).encode()).hexdigest()


def train_codes(embeddings: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Codes of all kept rows and the final codebooks, shape (parts, entries, width).

    Returns ``(rows, books)``: rows are those of ``embeddings`` that
    :func:`integer_vectors` keeps, all their columns, plus ``code`` (the entry
    of each part, two lowercase hex digits each, in part order) and ``error``
    (squared distances summed over parts). With fewer kept rows than
    ``entries`` the codebooks have as many entries as rows. Repeated rows and
    ids are coded alike, each row once. An empty table (or one without a kept
    row) gives no rows and empty codebooks; ``embeddings`` needs vec_id and
    embedding, other columns may have any names (``code`` and ``error`` are
    replaced).
    """
    whole = embeddings.select(F.monotonically_increasing_id().alias("_row"), F.struct("*").alias("_all"))
    whole = staged(whole, "embeddings")
    scaled = integer_vectors(whole.select("_row", "_all.vec_id", "_all.embedding"))
    scaled = staged(scaled.select("_row", "_id", "v"), "vectors")
    out = [F.col(f"_all.{c}").alias(c) for c in embeddings.columns if c not in ("code", "error")]
    if scaled.isEmpty():
        empty = whole.limit(0).select(*out, F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        return empty, np.zeros((PARTS, 0, 0), dtype=np.int64)
    books = _first_entries(scaled, entries)
    width = books.shape[2]
    scaled = scaled.where(F.size("v") == width * PARTS)
    schema = "part int, entry int, n long, total array<long>"
    for _ in range(rounds):
        partial = scaled.select("v").mapInArrow(_sums(books), schema)
        totals = partial.groupBy("part", "entry").agg(
            F.sum("n").alias("n"),
            F.array(*(F.sum(F.col("total")[i]) for i in range(width))).alias("total"),
        )
        books = _updated(books, totals.collect())
    coded = scaled.select("_row", "v").mapInArrow(_codes(books), "_row long, code string, error long")
    return whole.join(coded, "_row").select(*out, "code", "error"), books
