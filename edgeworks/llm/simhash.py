"""SimHash near-duplicate groups through a vantage-point tree over Hamming space.

fingerprints() reads each text once. near_components() shards the distinct fingerprints by the
top of a vantage-point tree fitted on a bounded sample. A fingerprint goes to its own side of each
vantage point's sphere and, from outside, also in where its radius-2 ball can overlap the
inside by the triangle inequality. Of two linked fingerprints on both sides the outer one is so near the sphere that
it has a copy inside, so they meet in a shard, and the inner ones need no copies. Inside a shard a local
vantage-point tree finds the exact pairs in the same way; only a spanning
forest of a shard's links leaves it, which keeps components whole without emitting all pairs.

Defined cases: a null or wordless text has fingerprint zero and links like any other; fewer words
than a shingle make one shingle of all words; repeated rows are each returned; a row with a null
doc_id keeps its fingerprint and takes the smallest non-null doc_id of its component (null where
there is none); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrow
from .components import connected_components, join_hot
from .tables import checkpoint, read

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Rows of the sample that the shards' vantage points are chosen from: so many a shard, within bounds; and fingerprints that a shard shall hold.
SAMPLE, LEAST_SAMPLE, MOST_SAMPLE = 8, 20_000, 1_000_000
SHARD_ROWS = 16_384
LEAST_SHARDS = 64
LEAF = 96

_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


def _fingerprint(hashes: np.ndarray) -> int:
    """Bit b is one if more than half of the hashes have it."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little")
    return int(bits.view("<i8")[0])


def text_fingerprints(column: pa.Array) -> np.ndarray:
    """Signed 64-bit fingerprints of whole texts."""
    out = np.zeros(len(column), np.int64)
    digest = xxhash.xxh64_intdigest
    for first, end, data, offsets in arrow.text_blocks(column):
        data = arrow.LOWER[data]
        starts, ends, first_word = arrow.words(data, offsets, _IS_WORD)
        # words of a text joined by one space: every word moves to a place of its own in a new buffer
        length = ends - starts
        place = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(length + 1, out=place[1:])
        joined = np.full(int(place[-1]), 0x20, np.uint8)
        flag = _IS_WORD[data]
        joined[np.arange(int(flag.sum())) + np.repeat(np.arange(len(starts)), length)] = data[flag]
        raw = joined.tobytes()
        begin, stop = place[:-1], place[1:] - 1
        for r in range(end - first):
            a, b = int(first_word[r]), int(first_word[r + 1])
            if a == b:
                continue
            k = min(SHINGLE, b - a)
            n = b - a - k + 1
            spans = zip(begin[a : a + n].tolist(), stop[a + k - 1 : b].tolist())
            out[first + r] = _fingerprint(np.fromiter((digest(raw[s:e], SEED) for s, e in spans), np.uint64, n))
    return out


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with its text column replaced by fingerprint (signed 64-bit)."""
    kept = [c for c in docs.columns if c not in (text, "fingerprint")]
    out = docs.select(*[F.col(arrow.quoted(c)) for c in [*kept, text]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = batch.column(batch.num_columns - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(text_fingerprints(t), pa.int64())], names=[*batch.schema.names[:-1], "fingerprint"])

    return arrow.mapped(out, run, len(kept), T.StructField("fingerprint", T.LongType()))


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.bitwise_xor(a, b))


class Node:
    """A vantage point with its threshold, or a leaf with a number."""

    __slots__ = ("far", "leaf", "near", "point", "threshold")

    def __init__(self, leaf=None, point=None, threshold=0, near=None, far=None):
        self.leaf, self.point, self.threshold, self.near, self.far = leaf, point, threshold, near, far


def _split(points: np.ndarray, rng: np.random.Generator) -> tuple[np.uint64, int, np.ndarray] | None:
    """The best of a few vantage points: least share of points within the radius of the boundary."""
    best = None
    for v in points[rng.integers(0, len(points), 5)]:
        d = hamming(points, v).astype(np.int64)
        t = int(np.median(d))
        for threshold in (t - 1, t):
            inside = d <= threshold
            if 0 < inside.sum() < len(points):
                cost = max(inside.mean(), 1 - inside.mean()) + np.mean(np.abs(d - threshold - 0.5) < RADIUS)
                if best is None or cost < best[0]:
                    best = cost, v, threshold, inside
    return best and best[1:]


def fit_tree(points: np.ndarray, leaf_size: float, leaves: list[np.ndarray]) -> Node:
    """A vantage-point tree over points; leaves gets the row numbers of each leaf."""
    rng = np.random.default_rng(1)

    def build(rows: np.ndarray) -> Node:
        parts = _split(points[rows], rng) if len(rows) > leaf_size else None
        if parts is None:
            leaves.append(rows)
            return Node(leaf=len(leaves) - 1)
        v, threshold, inside = parts
        return Node(point=v, threshold=threshold, near=build(rows[inside]), far=build(rows[~inside]))

    return build(np.arange(len(points)))


def search(node: Node, points: np.ndarray, rows: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """Yield (leaf, rows of points there): each on its own sides, and inside a sphere that its ball of this radius reaches into.

    Two points at most radius apart have a leaf in common: on either side of a threshold, the outer one's
    distance is at most the inner one's plus radius.
    """
    if not len(rows):
        return
    if node.leaf is not None:
        yield node.leaf, rows
        return
    d = hamming(points[rows], node.point).astype(np.int64)
    yield from search(node.near, points, rows[d - radius <= node.threshold], radius)
    yield from search(node.far, points, rows[d > node.threshold], radius)


def _roots(parent: np.ndarray, rows: np.ndarray) -> np.ndarray:
    found = parent[rows]
    while True:
        above = parent[found]
        if np.array_equal(above, found):
            parent[rows] = found
            return found
        found = above


def _union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[i] and b[i] for all i; a set's root is its smallest row."""
    while len(a):
        ra, rb = _roots(parent, a), _roots(parent, b)
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))


def shard_links(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of all links among a shard's points."""
    parent = np.arange(len(points))
    for _, rows in search(fit_tree(points, LEAF, []), points, np.arange(len(points)), RADIUS):
        step = max(1, (1 << 23) // len(rows))
        for k in range(0, len(rows), step):
            part = rows[k : k + step]
            q, r = np.nonzero(hamming(points[part][:, None], points[rows][None, :]) <= RADIUS)
            later = part[q] < rows[r]
            _union(parent, part[q[later]], rows[r[later]])
    found = _roots(parent, np.arange(len(points)))
    linked = np.flatnonzero(found != np.arange(len(points)))
    return points[linked], points[found[linked]]


def route(distinct: DataFrame, tree: Node) -> DataFrame:
    """(shard, fingerprint): each fingerprint in its own shard and in those that its ball reaches into."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            signed = batch["fingerprint"].to_numpy(np.int64)
            points = signed.view(np.uint64)
            for leaf, rows in search(tree, points, np.arange(len(points)), RADIUS):
                yield pd.DataFrame({"shard": leaf, "fingerprint": signed[rows]})

    return distinct.select("fingerprint").mapInPandas(run, "shard int, fingerprint long")


def near_links(distinct: DataFrame) -> DataFrame:
    """(a, b): a forest of links whose components are those of all pairs at RADIUS or fewer differing bits.

    distinct has each fingerprint once. The sample that fits the upper tree is bounded by MOST_SAMPLE;
    every fingerprint is routed and compared.
    """
    shards = max(LEAST_SHARDS, -(-distinct.count() // SHARD_ROWS))
    size = min(MOST_SAMPLE, max(LEAST_SAMPLE, SAMPLE * shards))
    sample = np.array([r[0] for r in distinct.orderBy(F.xxhash64("fingerprint")).limit(size).collect()], np.int64).view(np.uint64)
    tree = fit_tree(sample, len(sample) / shards * 1.5, [])

    def run(key, shard: pd.DataFrame) -> pd.DataFrame:
        a, b = shard_links(shard["fingerprint"].to_numpy(np.int64).view(np.uint64))
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return route(distinct, tree).groupBy("shard").applyInPandas(run, "a long, b long")


def near_components(prints: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """prints (with a fingerprint column) and component_id, the smallest doc_id that links lead to; all other columns are carried along."""
    prints = checkpoint(prints.select(*[F.col(arrow.quoted(c)) for c in prints.columns if c != "component_id"]))
    distinct = checkpoint(prints.groupBy("fingerprint").agg(F.min(arrow.quoted(doc_id)).alias("first"), F.count("*").alias("n")))
    roots = connected_components(near_links(distinct))
    # only fingerprints with links have a class that is not their own
    linked = checkpoint(distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint"))
    smallest = linked.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("n"))
    labels = join_hot(linked.select("fingerprint", "root"), smallest, "root").select("fingerprint", F.col("component_id").alias("first"), F.lit(True).alias("linked"))
    known = distinct.join(labels.withColumnRenamed("first", "least"), "fingerprint", "left")
    label = F.when(F.col("linked"), F.col("least")).otherwise(F.col("first"))
    return join_hot(prints, known.select("fingerprint", label.alias("component_id"), "n"), "fingerprint")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return near_components(fingerprints(docs)).select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
