"""Sharding by a minimax contiguous partition of ordered atomic groups.

A group is all rows of one text, and stays whole. Groups are ordered by a 64-bit hash of the text.
The smallest capacity for which a greedy walk needs no more than the given number of shards is
found by binary search, and the walk at that capacity gives the cuts.

The driver never sees the groups. It holds runs of neighbouring groups (a run is a prefix of the
hash), at most a few ten thousand: a run of several groups counts as divisible for a lower bound of
the capacity and as one piece for an upper bound. Only runs that a cut can fall into are split
further, by one grouped sum each round, until all of those are single groups; then both bounds
meet, and the partition is exact.

A group as large as an even share of what is left gets a shard of its own first, the largest ones
before the others: at most one a shard, read by a top-k of that many rows.

Defined cases: null counts as an empty text; equal texts share a shard; repeated rows get slots of
their own; fewer groups than shards leave shards empty; an empty table gives no rows; other columns
are carried along.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import arrow
from .tables import checkpoint, read

SHARDS = 24
ROW_OVERHEAD = 8
#: Hash bits of the first runs, and how many runs a round may have.
FIRST_BITS = 12
MOST_RUNS = 30_000
#: Rows that shall share a numbering bucket inside a shard.
BUCKET_ROWS = 4096
LEAST_BUCKETS = 64


def _boundary(stops: np.ndarray, divisible: np.ndarray, at: int) -> int:
    """The last position not beyond at where a cut can be: in a divisible run anywhere, else between runs."""
    i = int(np.searchsorted(stops, at, "right"))
    if i >= len(stops):
        return int(stops[-1])
    return at if divisible[i] else int(stops[i - 1]) if i else 0


def walk(stops: np.ndarray, divisible: np.ndarray, capacity: int, shards: int) -> list[int] | None:
    """Greedy cut positions (the end of each shard), or None if that many shards don't hold everything."""
    cuts, position = [], 0
    for _ in range(shards):
        position = _boundary(stops, divisible, position + capacity)
        cuts.append(position)
        if position == stops[-1]:
            return cuts
    return None


def smallest_capacity(stops: np.ndarray, divisible: np.ndarray, shards: int, least: int) -> int:
    low, high = max(least, -(-int(stops[-1]) // shards)), int(stops[-1])
    while low < high:
        middle = (low + high) // 2
        if walk(stops, divisible, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return low


class Runs:
    """Neighbouring groups as (first hash, bits of the prefix, bytes, groups, largest group), in order."""

    def __init__(self, rows: list[tuple[int, int, int, int, int]]):
        self.rows = sorted(rows)
        _, _, size, groups, largest = (np.array(x, np.int64) for x in zip(*self.rows, strict=True))
        self.stops, self.several, self.largest = np.cumsum(size), groups > 1, int(largest.max())

    def unclear(self, shards: int) -> list[int]:
        """Runs of several groups that some cut of the exact walk can fall into."""
        whole = np.zeros(len(self.rows), bool)
        low = smallest_capacity(self.stops, self.several, shards, self.largest)
        high = smallest_capacity(self.stops, whole, shards, self.largest)
        out: set[int] = set()
        first = last = 0
        for _ in range(shards):
            first = max(first, _boundary(self.stops, whole, first + low))
            last = _boundary(self.stops, self.several, last + high)
            a, b = np.searchsorted(self.stops, [first, last], "right")
            out.update(np.flatnonzero(self.several[a : b + 1]) + a)
        return sorted(out)


def _runs(groups: DataFrame, bits: int) -> list[tuple[int, int, int, int, int]]:
    first = F.shiftleft(F.shiftright("key", 64 - bits), 64 - bits)
    rows = groups.groupBy(first.alias("first")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("groups"), F.max("bytes").alias("largest")).collect()
    return [(r["first"], bits, r["bytes"], r["groups"], r["largest"]) for r in rows]


def minimax_cuts(groups: DataFrame, shards: int) -> list[int]:
    """First keys of the second and later shards, for groups(key long, bytes long) with distinct keys."""
    rows = _runs(groups, FIRST_BITS)
    if not rows:
        return []
    runs = Runs(rows)
    while unclear := runs.unclear(shards):
        chosen = [runs.rows[i] for i in unclear]
        more = max(1, int(np.log2(max(2, MOST_RUNS // len(chosen)))))
        parts = []
        for bits in sorted({r[1] for r in chosen}):
            firsts = [r[0] for r in chosen if r[1] == bits]
            prefix = F.shiftleft(F.shiftright("key", 64 - bits), 64 - bits)
            wanted = groups.sparkSession.createDataFrame([(x,) for x in firsts], "first long")
            inside = groups.withColumn("first", prefix).join(F.broadcast(wanted), "first", "left_semi")
            parts += _runs(inside, min(64, bits + more))
        gone = set(unclear)
        runs = Runs([r for i, r in enumerate(runs.rows) if i not in gone] + parts)
    capacity = smallest_capacity(runs.stops, runs.several, shards, runs.largest)
    ends = walk(runs.stops, runs.several, capacity, shards)
    at = np.searchsorted(runs.stops, ends[:-1], "right")
    return [runs.rows[i][0] for i in at]


def assign_shards(docs: DataFrame, shards: int = SHARDS, text: str = "text") -> DataFrame:
    """docs with size, shard and slot, which replace columns of these names. Equal texts share a shard; sizes are as near as the order allows."""
    kept = [c for c in docs.columns if c not in ("size", "shard", "slot")]
    body = F.coalesce(F.col(arrow.quoted(text)), F.lit(""))
    (key,) = arrow.free([*kept, "size", "shard", "slot"], "key")
    rows = docs.select(*[F.col(arrow.quoted(c)) for c in kept], (F.octet_length(body) + ROW_OVERHEAD).cast("long").alias("size"), F.xxhash64(body).alias(key))
    groups = checkpoint(rows.groupBy(F.col(key).alias("key")).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")))
    total, n_rows = groups.agg(F.sum("bytes"), F.sum("rows")).first()
    total, alone = total or 0, []
    for r in groups.orderBy(F.desc("bytes"), "key").limit(shards).collect():
        left = shards - len(alone)
        if left > 1 and r["bytes"] * left >= total:
            alone.append(r["key"])
            total -= r["bytes"]
    rest = groups.where(~F.col("key").isin(alone)) if alone else groups
    cuts = minimax_cuts(rest, shards - len(alone))
    # the lists are no longer than the number of shards
    shard = F.lit(len(alone))
    for first in cuts:
        shard = shard + (F.col(key) >= F.lit(first)).cast("int")
    for k, own in enumerate(alone):
        shard = F.when(F.col(key) == F.lit(own), F.lit(k)).otherwise(shard)
    buckets = max(LEAST_BUCKETS, -(-(n_rows or 0) // (shards * BUCKET_ROWS)))
    return _with_slots(rows.withColumn("shard", shard.cast("int")), buckets, key).drop(key)


def _with_slots(rows: DataFrame, buckets: int, key: str) -> DataFrame:
    """Number each shard's rows from 0: in buckets by doc_id and text, plus the rows of the buckets before."""
    bucket, ahead, place = arrow.free(rows.columns, "bucket", "ahead", "place")
    # rows without doc_id are spread by their texts
    rows = rows.withColumn(bucket, F.pmod(F.xxhash64("doc_id", key), F.lit(buckets)).cast("int"))
    counts = rows.groupBy("shard", bucket).agg(F.count("*").alias("n"))
    # as many rows as shards times buckets
    before = F.sum("n").over(Window.partitionBy("shard").orderBy(bucket)) - F.col("n")
    counts = counts.select("shard", bucket, before.alias(ahead))
    numbered = rows.withColumn(place, F.row_number().over(Window.partitionBy("shard", bucket).orderBy("doc_id", key, "size")) - 1)
    return numbered.join(counts, ["shard", bucket]).withColumn("slot", F.col(ahead) + F.col(place)).drop(bucket, ahead, place)


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder a shard, rows in slot order within each file."""
    assigned.repartition("shard", F.floor(F.col("slot") / (BUCKET_ROWS * 16))).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    # the texts stay behind: only their size and digests go through the shuffles
    slim = docs.select("doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), "text")
    return assign_shards(slim).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
