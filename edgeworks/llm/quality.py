"""Quality: document evidence combined with posteriors of its host and path by empirical Bayes.

The evidence of a text is a logistic model on byte and word statistics, fitted on a bounded sample of
labelled documents. Every document counts at its site: with its label if it may be learnt from,
else with the probability that its text gives. Sites form two levels below the global mean: hosts, and paths on a
host. Each level is a beta prior around the mean above it, whose strength comes from how much the
sites of that level differ beyond chance (method of moments over grouped sums); a sparse site
stays near the level above. The score moves the document's own log odds by its path's shift.

Sums by path, then by host, then one row for the moments: grouped aggregates that combine before
each shuffle, so a host with a third of all rows is no burden.

Defined cases: a null text is empty; null hosts or paths are sites of their own; a label other
than 0 or 1, or without doc_id, is not learnt from; without labels of both kinds the evidence is one
half everywhere; repeated rows count each; other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrow
from .tables import checkpoint, read
from .toxicity import held_out, training_rows

MAX_TRAIN = 20_000
FEATURES = 12
NEWTON_STEPS, RIDGE = 25, 1e-3
#: Bounds of a prior's strength, in documents.
WEAKEST, STRONGEST = 1.0, 1e6
CLIP = 1e-4

_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_CLASSES = np.zeros(256, np.int64)
_CLASSES[0x61:0x7B] = _CLASSES[0x80:] = 1
_CLASSES[0x41:0x5B] = 2
_CLASSES[0x30:0x3A] = 3
_CLASSES[[0x2E, 0x2C, 0x3B, 0x3A, 0x27, 0x22, 0x3F]] = 4
_CLASSES[[0x20, 0x09, 0x0D]] = 5
_CLASSES[0x0A] = 6


def text_features(column: pa.Array) -> np.ndarray:
    """FEATURES numbers a text: length, shares of byte classes, word length, repeated words."""
    out = np.zeros((len(column), FEATURES))
    for first, end, data, offsets in arrow.text_blocks(column):
        n = end - first
        row = np.repeat(np.arange(n), np.diff(offsets))
        counts = np.bincount(row * 7 + _CLASSES[data], minlength=7 * n).reshape(n, 7)
        size = np.maximum(1, np.diff(offsets))
        starts, ends, first_word = arrow.words(data, offsets, _IS_WORD)
        h = arrow.word_hashes(data, starts, ends)
        words = np.diff(first_word)
        of = np.repeat(np.arange(n), words)
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
        order = np.lexsort((h, of))
        new = np.ones(len(h), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (of[order][1:] != of[order][:-1])
        distinct = np.bincount(of[order][new], minlength=n)
        some = np.maximum(1, words)
        part = out[first:end]
        part[:, 0] = np.log1p(words)
        part[:, 1:8] = counts / size[:, None]
        part[:, 8] = np.log1p(np.bincount(of, ends - starts, minlength=n) / some)
        part[:, 9] = np.bincount(of, same, minlength=n) / some
        part[:, 10] = distinct / some
        part[:, 11] = distinct / some * np.log1p(words)
    return out


class Evidence:
    """A logistic model on standardised features and their squares; without weights it says one half."""

    def __init__(self, middle: np.ndarray, scale: np.ndarray, weights: np.ndarray | None):
        self.middle, self.scale, self.weights = middle, scale, weights

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.middle) / self.scale, -6, 6)
        return np.hstack([np.ones((len(x), 1)), z, z * z])

    def probabilities(self, column: pa.Array) -> np.ndarray:
        if self.weights is None:
            return np.full(len(column), 0.5)
        z = self.design(text_features(column)) @ self.weights
        return np.clip(1 / (1 + np.exp(-np.clip(z, -30, 30))), CLIP, 1 - CLIP)


def fit_evidence(rows: DataFrame) -> Evidence:
    """rows(text, label) must be bounded; their features, not the texts, reach the driver. Newton steps on the ridge likelihood."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = text_features(batch.column(0))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), FEATURES).cast(pa.list_(pa.float64()))], names=["label", "x"])

    got = rows.mapInArrow(run, "label int, x array<double>").toPandas()
    y = got["label"].to_numpy(float)
    nothing = Evidence(np.zeros(FEATURES), np.ones(FEATURES), None)
    if not len(y) or y.min() == y.max():
        return nothing
    x = np.stack(got["x"].to_list())
    order = np.lexsort((*x.T, y))
    x, y = x[order], y[order]
    model = Evidence(x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9), None)
    d = model.design(x)
    w = np.zeros(d.shape[1])
    for _ in range(NEWTON_STEPS):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        gradient = d.T @ (p - y) / len(y) + RIDGE * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d / len(y) + RIDGE * np.eye(len(w))
        w = w - np.linalg.solve(hessian, gradient)
    model.weights = w
    return model


def with_evidence(docs: DataFrame, model: Evidence, text: str = "text", into: str = "evidence") -> DataFrame:
    kept = [c for c in docs.columns if c not in (into, text)]
    source = docs.select(*[F.col(arrow.quoted(c)) for c in [*kept, text]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(model.probabilities(batch.column(batch.num_columns - 1)))], names=[*batch.schema.names[:-1], into])

    return arrow.mapped(source, run, len(kept), T.StructField(into, T.DoubleType()))


def _logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - CLIP)), F.lit(CLIP))
    return F.log(p / (1 - p))


def prior_strength(mean: Column) -> Column:
    """An aggregate over sites(n, good): documents that the prior is worth, from the variance of the sites'
    shares around mean beyond what n draws would give.
    """
    spread = F.sum((F.col("good") - F.col("n") * mean) ** 2 / F.col("n"))
    chance, room = F.sum(mean * (1 - mean)), F.sum((F.col("n") - 1) * mean * (1 - mean))
    # share of the variance that lies between sites; strength is its odds against
    between = F.greatest(F.lit(0.0), F.try_divide(spread - chance, room))
    strength = F.try_divide(1 - between, between)
    return F.least(F.greatest(F.coalesce(strength, F.lit(STRONGEST)), F.lit(WEAKEST)), F.lit(STRONGEST))


def site_posteriors(counted: DataFrame, host: str, path: str) -> DataFrame:
    """(host, path, prior, host_posterior, path_posterior) from rows with a weight `good` in 0..1."""
    paths = checkpoint(counted.groupBy(host, path).agg(F.count("*").alias("n"), F.sum("good").alias("good")))
    hosts = paths.groupBy(host).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    top = hosts.agg((F.sum("good") / F.sum("n")).alias("prior"))
    # one row, and the rows of hosts
    hosts = hosts.crossJoin(F.broadcast(top))
    strength = hosts.agg(prior_strength(F.col("prior")).alias("k"))
    hosts = hosts.crossJoin(F.broadcast(strength)).select(host, "prior", ((F.col("good") + F.col("k") * F.col("prior")) / (F.col("n") + F.col("k"))).alias("host_posterior"))
    same = arrow.free([host, path], "host_again")[0]
    joined = paths.join(hosts.withColumnRenamed(host, same), F.col(host).eqNullSafe(F.col(same))).drop(same)
    strength = joined.agg(prior_strength(F.col("host_posterior")).alias("k"))
    posterior = (F.col("good") + F.col("k") * F.col("host_posterior")) / (F.col("n") + F.col("k"))
    return joined.crossJoin(F.broadcast(strength)).select(host, path, "prior", "host_posterior", posterior.alias("path_posterior"))


def score(docs: DataFrame, labels: DataFrame, host: Column, path: Column, max_train: int = MAX_TRAIN) -> DataFrame:
    """docs (doc_id, text and others) with evidence, prior, posteriors and quality_score, without the text.

    Columns of these names are replaced, all others carried along. Labels of the held-out fold are never learnt from.
    """
    made = ("evidence", "prior", "host_posterior", "path_posterior", "quality_score")
    h, p, site, of, label = arrow.free([*docs.columns, *made, "good"], "host", "path", "of_host", "of_path", "label")
    docs = docs.withColumns({h: host, p: path}).select(*[F.col(arrow.quoted(c)) for c in [*[c for c in docs.columns if c not in made], h, p]])
    model = fit_evidence(checkpoint(training_rows(docs, labels, "quality", max_train)))
    rows = checkpoint(with_evidence(docs, model))
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.avg("quality").alias(label))
    counted = rows.select("doc_id", h, p, "evidence").join(known, "doc_id", "left").withColumn("good", F.coalesce(label, "evidence"))
    sites = site_posteriors(counted, h, p).withColumnsRenamed({h: site, p: of})
    joined = rows.join(sites, F.col(h).eqNullSafe(F.col(site)) & F.col(p).eqNullSafe(F.col(of))).drop(h, p, site, of)
    odds = _logit(F.col("evidence")) + _logit(F.col("path_posterior")) - _logit(F.col("prior"))
    return joined.withColumn("quality_score", 1 / (1 + F.exp(-odds)))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites of a document: its source as the host, and its language there as the path."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    scored = score(docs, read(spark, sf_dir, "labels"), F.col("source"), F.concat_ws("/", "source", "lang"))
    digits = [F.round(c, 6).alias(c) for c in ("evidence", "host_posterior", "path_posterior")]
    return scored.select("doc_id", held_out().alias("held_out"), *digits, F.round("quality_score", 6).alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))
