"""Languages from averaged embeddings of hashed subwords.

The subwords of a text are the grams of 3 and 4 bytes of its lower-cased words, a
word's edges included, hashed to ``BUCKETS``. A text is the mean of their
embeddings; a linear softmax over it gives the languages. Both are trained
together by stochastic gradient descent in numpy, on a sample of the labelled rows,
of which executors send hashed counts, never texts. It has rows of every language
that has a label: ``PER_LANGUAGE``, or of very many languages so many fewer that
they are ``ROWS`` together, but one at least. Five-fold cross-validation on the
sample calibrates the scores (a temperature) and sets the score below which a
prediction is not accepted, at every sample size alike; the model itself learns
from the whole sample.

As the classifier is linear in the mean, a bucket needs one number per language
for predicting. They are whole numbers, so sums do not depend on how texts are
cut into batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import hash52, lean_batches, staged

BUCKETS_LOG2 = 15
FOLDS = 5
BUCKETS = 1 << BUCKETS_LOG2
DIMENSIONS = 16
PER_LANGUAGE = 400
ROWS = 25_600
#: Part of right predictions that may be turned down.
TURNED_DOWN = 0.005
UNDETERMINED = "und"

_FIXED = 1 << 20
_STEP = 1 << 20
_FOLD = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def _bytes(text: str | None) -> bytes:
    """Lower case, all ASCII but letters as spaces, a space around."""
    return b" " + (text or "").lower().encode("utf-8", "replace").translate(_FOLD) + b" "


def _buckets(data: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Places from ``first`` to ``last`` at which a gram starts, and its bucket, for both sizes."""
    some = data[first : last + 3].astype(np.uint32)
    places, buckets = [], []
    for size in (3, 4):
        n = min(last - first, len(some) - size + 1)
        if n <= 0:
            continue
        code = np.full(n, size, np.uint32)
        inside = np.ones(n, bool)
        for i in range(size):
            code = code * np.uint32(0x01000193) ^ some[i : i + n]
            if 0 < i < size - 1:
                inside &= some[i : i + n] != 0x20
        at = np.flatnonzero(inside)
        places.append(at + first)
        buckets.append((code[at] * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS_LOG2))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    return np.concatenate(places), np.concatenate(buckets)


def subword_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text's subwords and how often each occurs."""
    data = np.frombuffer(_bytes(text), np.uint8)
    total = np.zeros(BUCKETS, np.int64)
    for first in range(0, len(data), _STEP):
        total += np.bincount(_buckets(data, first, min(first + _STEP, len(data)))[1], minlength=BUCKETS)
    used = np.flatnonzero(total)
    return used.astype(np.int32), total[used].astype(np.float32)


def held_out() -> Column:
    """The fold that is not learnt from; a null id is not in it."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # whole numbers, bucket x language
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        logits = sums / _FIXED / np.maximum(counts, 1)[:, None] + self.bias
        return _softmax(logits / self.temperature)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probabilities of the languages of each text."""
        parts = [_bytes(t) for t in texts]
        ends = np.cumsum([len(p) for p in parts])
        data = np.frombuffer(b"".join(parts), np.uint8)
        sums = np.zeros((len(texts), len(self.languages)), np.int64)
        counts = np.zeros(len(texts), np.int64)
        step = max(1 << 14, _STEP // len(self.languages))
        for first in range(0, len(data), step):
            last = min(first + step, len(data))
            places, buckets = _buckets(data, first, last)
            of = np.searchsorted(ends, places, side="right")
            order = np.argsort(of, kind="stable")
            texts_here, begin = np.unique(of[order], return_index=True)
            if len(texts_here):
                sums[texts_here] += np.add.reduceat(self.weights[buckets[order]], begin, axis=0)
                counts += np.bincount(of, minlength=len(texts))
        return self.probabilities(sums, counts)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, max_languages: int | None = None, rows: int = ROWS) -> DataFrame:
    """lang and hashed counts of a bounded sample of the labelled rows that may be learnt from.

    A row is in it if a hash of its id is small enough for its language, or the
    smallest of its language, so that each has one. At most ``per_language`` rows a
    language are meant. ``rows``, or one a language if there are more of them, are
    the bound, divided equally. ``max_languages`` asks for the most frequent ones
    only, ``per_language`` times as many rows being the bound.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select(
        "lang", "text", hash52("language", F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias("chance")
    )
    counts = labelled.groupBy(F.col("lang").alias("_lang")).agg(F.count(F.lit(1)).alias("count"), F.min("chance").alias("least"))
    if max_languages is not None:
        counts, rows = counts.orderBy(F.desc("count"), "_lang").limit(max_languages), per_language * max_languages
    counts = staged(counts, "languages")
    bound = max(1, rows // max(1, counts.count()))
    small = F.col("chance").cast("double") * F.col("count") < F.lit(float(2**52)) * min(per_language, bound)
    chosen = labelled.join(counts, F.col("lang") == F.col("_lang")).where(small | (F.col("chance") == F.col("least")))
    # More than meant may have an id's chance, if it is repeated. Tasks drop theirs before the shuffle
    # (Spark does that for limits up to 1000).
    bound = min(bound, 2 * per_language)
    first = Window.partitionBy("lang").orderBy("chance", F.xxhash64("text"), "text")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [subword_counts(t) for t in b["text"]]
            yield pd.DataFrame(
                {"lang": b["lang"], "chance": b["chance"], "used": [u for u, _ in found], "times": [t for _, t in found]}
            )

    bag = chosen.withColumn("place", F.row_number().over(first)).where(F.col("place") <= bound).select("lang", "text", "chance")
    return bag.mapInPandas(counted, "lang string, chance long, used array<int>, times array<float>")


def _train(rows: pd.DataFrame, languages: list[str], epochs: int = 12, rate: float = 8.0) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings times output weights (bucket x language), and the bias."""
    rng = np.random.default_rng(9)
    embeddings = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output = rng.normal(0, 0.1, (DIMENSIONS, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    truth = np.array([languages.index(x) for x in rows["lang"]])
    used = [np.asarray(u, np.int64) for u in rows["used"]]
    part = [np.asarray(t, np.float32) / max(1.0, float(np.sum(t))) for t in rows["times"]]
    # Languages count alike, however many rows they have.
    share = 1.0 / np.maximum(1, np.bincount(truth, minlength=len(languages)))
    share *= len(truth) / share[truth].sum()
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(len(truth)):
            mean = part[i] @ embeddings[used[i]] if len(used[i]) else np.zeros(DIMENSIONS, np.float32)
            logits = mean @ output + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[truth[i]] -= 1
            error *= share[truth[i]]
            back = output @ error
            output -= step * 0.1 * np.outer(mean, error)
            bias -= step * 0.01 * error
            embeddings[used[i]] -= step * part[i][:, None] * back
    return embeddings.astype(np.float64) @ output, bias.astype(np.float64)


def _model(rows: pd.DataFrame, languages: list[str]) -> Model:
    table, bias = _train(rows.reset_index(drop=True), languages)
    return Model(languages, np.round(table * _FIXED).astype(np.int64), bias, 1.0, 0.0)


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, max_languages: int | None = None) -> Model | None:
    """A model of ``docs`` (doc_id, text, lang), or None if no row has a label to learn from.

    The model learns from all sampled rows. Its temperature and rejection
    threshold come from ``FOLDS``-fold cross-validation on the same rows: each
    row is scored by a model that did not learn from it, at every sample size
    alike (a fold without rows to learn from gives a model that knows nothing,
    whose scores then count against it).
    """
    rows = sample(docs, per_language, max_languages).toPandas()
    if not len(rows):
        return None
    rows = rows.sort_values(["chance", "lang"], kind="stable", ignore_index=True)
    languages = sorted(rows["lang"].unique())
    fold = np.arange(len(rows)) % FOLDS
    judged = []
    for k in range(FOLDS):
        tried = rows[fold == k]
        if not len(tried):
            continue
        model = _model(rows[fold != k], languages)
        times = [np.asarray(t, np.int64) for t in tried["times"]]
        sums = np.array([t @ model.weights[np.asarray(u, np.int64)] for u, t in zip(tried["used"], times, strict=True)])
        counts = np.array([t.sum() for t in times])
        judged.append((model, sums.reshape(len(tried), len(languages)), counts, np.array([languages.index(x) for x in tried["lang"]])))

    def found(temperature: float) -> list[np.ndarray]:
        for model, *_ in judged:
            model.temperature = temperature
        return [model.probabilities(sums, counts) for model, sums, counts, _ in judged]

    def loss(temperature: float) -> float:
        chances = [p[np.arange(len(truth)), truth] for p, (*_, truth) in zip(found(temperature), judged)]
        return -np.log(np.concatenate(chances) + 1e-12).mean()

    final = _model(rows, languages)
    final.temperature = min(np.geomspace(0.05, 20, 60).tolist(), key=loss)
    right = np.concatenate(
        [p.max(axis=1)[p.argmax(axis=1) == truth] for p, (*_, truth) in zip(found(final.temperature), judged)]
    )
    final.threshold = float(np.quantile(right, TURNED_DOWN)) if len(right) else 0.0
    return final


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted: a row per row of ``docs``.

    Only the text is looked at, all of it. ``lang_pred`` is ``und`` (score 0, not
    accepted) if it is null or has no letter, or if nothing was learnt. Repeated
    rows give repeated rows, an empty table an empty one.
    """
    if model is None:
        found = F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    else:

        @F.pandas_udf("lang string, score double, accepted boolean")
        def best(texts: pd.Series) -> pd.DataFrame:
            scores = model.scores(texts.tolist())
            top = scores.argmax(axis=1) if len(scores) else np.zeros(0, np.int64)
            score = np.round(scores.max(axis=1), 6) if len(scores) else np.zeros(0)
            return pd.DataFrame(
                {"lang": [model.languages[i] for i in top], "score": score, "accepted": score >= model.threshold}
            )

        found = best(F.col("text"))
    # A letter of any script.
    readable = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select("doc_id", held_out().alias("held_out"), readable.alias("readable"), found.alias("found")).select(
        "doc_id",
        "held_out",
        F.when(F.col("readable"), F.col("found.lang")).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(F.col("readable"), F.col("found.score")).otherwise(0.0).alias("score"),
        (F.col("readable") & F.col("found.accepted")).alias("accepted"),
    )


def identify(docs: DataFrame, **bounds: int) -> DataFrame:
    """Fit on the labelled rows outside the held-out fold, predict all."""
    lean_batches(docs.sparkSession)
    return predict(docs, fit(docs, **bounds))
