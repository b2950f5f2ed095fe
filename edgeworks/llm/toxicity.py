"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct n-grams of NGRAMS code points of the lower-cased text, hashed
to 2**BITS buckets. From the labelled sample, each bucket gets the smoothed log ratio r of its
share of toxic and clean documents; the KEEP buckets that tell most stay, and a logistic model is
fitted on the features scaled by r. Scoring adds the weights of the buckets present in a whole text.

The sample of labelled rows that the model is fitted on is bounded by MAX_TRAIN distinct rows, taken by a hash
of doc_id, so it does not depend on partitioning; all documents are scored. The grouped counts,
not the texts, reach the driver, and the kept features of at most MAX_TRAIN rows: two bytes each, KEEP a row at most.

Defined cases: null is an empty text; a text without kept features (empty ones too) scores the
model's base rate; rows without a label or doc_id are not trained on; without training rows of
both labels all scores are 0; repeated rows are each scored; other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrow
from .tables import checkpoint, read

NGRAMS = (3, 4, 5, 6)
BITS = 18
KEEP = 4096
MAX_TRAIN = 20_000
FOLDS = 5
#: A bucket needs so many labelled documents of one class, to leave chance n-grams out.
LEAST_DOCS = 3
#: And so much log-likelihood gain, far beyond what chance gives among 2**BITS buckets.
LEAST_GAIN = 8.0
#: Most steps of the solver, and the change of all weights at which it ends.
STEPS, TOLERANCE = 400, 1e-5
RIDGE = 1.0

_M = np.uint64(0x9E3779B97F4A7C15)
_C = np.uint64(0xD6E8FEB86659FD93)
BLOCK_CHARS = 1 << 18


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that labels are never learnt from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0


def _grams(points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each n the bucket of the n-gram that starts at each place."""
    # the finaliser is one multiplication: the upper bits of the product depend on the whole gram
    value = (points.astype(np.uint64) + np.uint64(1)) * _C
    h = value.copy()
    for n in range(2, NGRAMS[-1] + 1):
        if len(h) < 2:
            return
        h = h[:-1] * _M + value[n - 1 :]
        if n in NGRAMS:
            yield n, (((h ^ (h >> np.uint64(29))) * _C) >> np.uint64(64 - BITS)).astype(np.int32)


def _blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, code points, offsets) of consecutive texts, lower-cased."""
    for first, end, data, offsets in arrow.text_blocks(column, BLOCK_CHARS):
        raw = data.tobytes()
        texts = [raw[a:b].decode("utf-8", "replace").lower() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        place = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=place[1:])
        yield first, points, place


def present(column: pa.Array, number: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct (row, feature) pairs; number maps a bucket to a feature, or to -1."""
    wanted = number >= 0
    for first, points, place in _blocks(column):
        found = []
        for n, bucket in _grams(points):
            at = np.flatnonzero(wanted[bucket])
            row = np.searchsorted(place, at, "right") - 1
            inside = at + n <= place[row + 1]
            # lengths of an n-gram are features of their own
            found.append(row[inside] * (len(number) * 8) + number[bucket[at[inside]]])
        if found:
            pair = np.unique(np.concatenate(found))
            yield first + pair // (len(number) * 8), pair % (len(number) * 8)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, max_train: int = MAX_TRAIN) -> DataFrame:
    """(text, label) of at most max_train distinct labelled rows outside the held-out fold, those with the least keys.

    The labels are sent to the texts. A doc_id may have many rows, so the bound is taken once more over these.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", F.col(label).cast("int").alias("label")).distinct()
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_train)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = rows.select(F.struct(F.xxhash64("doc_id"), "doc_id", "label", F.xxhash64("text")).alias("key"), "text", "label")
    # as many keys as rows are wanted at most, without the texts
    keys = rows.select("key").distinct().orderBy("key").limit(max_train)
    rows = rows.join(F.broadcast(keys), "key", "left_semi").dropDuplicates(["key"])
    return rows.select("text", "label").repartition(docs.sparkSession.sparkContext.defaultParallelism)


class Model:
    """Base score and weights of the kept buckets."""

    def __init__(self, number: np.ndarray, weights: np.ndarray, base: float | None):
        self.number, self.weights, self.base = number, weights, base

    def scores(self, column: pa.Array) -> np.ndarray:
        if self.base is None:
            return np.zeros(len(column))
        total = np.full(len(column), self.base)
        for row, feature in present(column, self.number):
            total += np.bincount(row, self.weights[feature], minlength=len(column))
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _logistic(rows: np.ndarray, features: np.ndarray, scale: np.ndarray, y: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on sparse scaled presence features, by accelerated gradient steps."""
    x = scale[features]
    w, b = np.zeros(size), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    vw, vb, n = w.copy(), b, len(y)
    row_norm = np.bincount(rows, x * x, minlength=n)
    step = 4 * n / (float(np.percentile(row_norm, 99)) * n + n + RIDGE * 4) * 4 if n else 0
    weight = np.where(y == 1, (n - y.sum()) / max(1, y.sum()), 1.0) ** 0.5
    for k in range(STEPS):
        z = vb + np.bincount(rows, x * vw[features], minlength=n)
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        gw = np.bincount(features, x * error[rows], minlength=size) + RIDGE * vw
        new_w, new_b = vw - step * gw / n, vb - step * error.mean()
        if max(np.abs(new_w - w).max(initial=0), abs(new_b - b)) < TOLERANCE:
            w, b = new_w, new_b
            break
        m = k / (k + 3)
        vw, vb = new_w + m * (new_w - w), new_b + m * (new_b - b)
        w, b = new_w, new_b
    return w * scale, b


def fit(rows: DataFrame) -> Model:
    """rows(text, label) must be bounded. Two passes: counts by bucket, then the kept features of each row."""
    everything = np.arange(1 << BITS, dtype=np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << BITS), np.int64)
        size = np.zeros(2, np.int64)
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            size += np.bincount(label, minlength=2)
            for row, feature in present(batch.column(0), everything):
                for y in (0, 1):
                    total[y] += np.bincount(feature[label[row] == y], minlength=1 << BITS)
        k = np.flatnonzero(total.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(k, -1), pa.int32()), *(pa.array(np.append(total[y][k], size[y]), pa.int64()) for y in (0, 1))], names=["bucket", "clean", "toxic"])

    counts = rows.mapInArrow(count, "bucket int, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    bucket, clean, toxic = (np.asarray(counts[c], np.int64) for c in ("bucket", "clean", "toxic"))
    none = Model(np.full(1 << BITS, -1), np.zeros(0), None)
    if not (bucket == -1).any():
        return none
    n0, n1 = int(clean[bucket == -1][0]), int(toxic[bucket == -1][0])
    if not n0 or not n1:
        return none
    order = np.argsort(bucket)[1:]
    bucket, clean, toxic = bucket[order], clean[order], toxic[order]
    ratio = np.log((toxic + 0.5) / (n1 + 1)) - np.log((clean + 0.5) / (n0 + 1))
    # how much presence tells about the label: log-likelihood gain of the bucket's own share of toxic rows
    seen, share = toxic + clean, n1 / (n0 + n1)
    own = np.clip((toxic + share) / (seen + 1), 1e-9, 1 - 1e-9)
    gain = toxic * np.log(own / share) + clean * np.log((1 - own) / (1 - share))
    # only buckets that speak for toxicity stay: the many weak signs of clean text would add up with a text's length
    gain[(toxic < LEAST_DOCS) | (own <= share)] = -1
    best = np.lexsort((bucket, -gain))[:KEEP]
    best = best[gain[best] > LEAST_GAIN]
    number = np.full(1 << BITS, -1)
    number[bucket[best]] = np.arange(len(best))
    scale = ratio[best]

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            rows_of = [np.empty(0, np.int64)]
            features_of = [np.empty(0, np.int64)]
            for row, feature in present(batch.column(0), number):
                rows_of.append(row)
                features_of.append(feature)
            row, feature = np.concatenate(rows_of), np.concatenate(features_of)
            ends = np.searchsorted(row, np.arange(len(label) + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(feature, pa.int16()))
            yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), lists], names=["label", "features"])

    got = rows.mapInArrow(features, "label int, features array<short>").toArrow()
    y = np.asarray(got["label"], np.int64)
    lists = got["features"].combine_chunks() if got["features"].num_chunks != 1 else got["features"].chunk(0)
    size = np.asarray(pc.list_value_length(lists), np.int64)
    weights, base = _logistic(np.repeat(np.arange(len(y)), size), np.asarray(lists.flatten(), np.int64), scale, y.astype(float), len(best))
    return Model(number, weights, base)


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """docs with a score column in 0..1; every other column is carried along."""
    kept = [c for c in docs.columns if c != into]
    source = docs.select(*[F.col(arrow.quoted(c)) for c in kept])
    place = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(batch.column(place)))], names=[*batch.schema.names, into])

    return arrow.mapped(source, run, len(kept), T.StructField(into, T.DoubleType()))


def fit_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    return fit(checkpoint(training_rows(docs, read(spark, sf_dir, "labels"), "toxic")))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit_toxic(spark, docs, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
