"""Reciprocal edges, pruning near a root, and nearest values."""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ids import running
from .model import dealt

#: Values of a library that becomes an expression.
MOST_LITERALS = 200


def reciprocal_exact(df: DataFrame) -> DataFrame:
    """Edges with a mirrored partner: partner_id, by rank of id among edges of equal place.

    Both directions of a pair get one key, so one exchange serves the ranking and the join.
    """
    forward = F.col("src") < F.col("dst")
    swap = lambda a, b: F.when(forward, F.col(a)).otherwise(F.col(b))
    keyed = df.where("src <> dst").select(
        "synapse_id", "src", "dst", F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), forward.alias("forward"),
        swap("efferent_section_id", "afferent_section_id").alias("s1"), swap("afferent_section_id", "efferent_section_id").alias("s2"),
        swap("efferent_segment_id", "afferent_segment_id").alias("g1"), swap("afferent_segment_id", "efferent_segment_id").alias("g2"),
    )
    keys = ["a", "b", "s1", "s2", "g1", "g2"]
    ranked = keyed.withColumn("place", F.row_number().over(Window.partitionBy(*keys, "forward").orderBy("synapse_id")))
    w = Window.partitionBy(*keys, "place")
    both = ranked.withColumn("partner_id", F.sum("synapse_id").over(w) - F.col("synapse_id")).withColumn("__n", F.count("*").over(w))
    return both.where("__n = 2").select("src", "dst", "synapse_id", "partner_id")


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Rows sorted by keys, cut so that no group is in two frames; far fewer calls than one a group."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        changed = (batch[keys] != batch[keys].shift()).any(axis=1).to_numpy()
        if held:
            changed[0] = (held[-1][keys].iloc[-1] != batch[keys].iloc[0]).any()
        cuts = np.flatnonzero(changed)
        if not len(cuts):
            held.append(batch)
            continue
        done = [*held, batch.iloc[: cuts[-1]]]
        if sum(map(len, done)):
            yield pd.concat(done, ignore_index=True)
        held = [batch.iloc[cuts[-1] :]]
    if held:
        yield pd.concat(held, ignore_index=True)


_MIRROR = ["a", "b", "s1", "s2"]


def _pairs_of(rows: pd.DataFrame) -> pd.DataFrame:
    """Partners among edges in the order of mirrored place, direction and id: an edge takes the first free one of equal segments, else the first free one at most one segment away.

    The edges that wait lie in queues by their segments, so an edge looks at nine heads however many wait.
    """
    places, forward = rows[_MIRROR].to_numpy(), rows["forward"].to_numpy()
    ids, g1, g2 = (rows[c].tolist() for c in ("synapse_id", "g1", "g2"))
    cuts = np.flatnonzero(np.append(True, (places[1:] != places[:-1]).any(axis=1)))
    out: list[tuple[int, int, int, int]] = []
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(rows)], strict=True):
        first = a + int(np.count_nonzero(~forward[a:b]))
        if first in (a, b):
            continue
        waiting: dict[tuple[int, int], deque[int]] = defaultdict(deque)
        for j in range(a, first):
            waiting[g1[j], g2[j]].append(ids[j])
        for i in range(first, b):
            x, y = g1[i], g2[i]
            queue = waiting.get((x, y))
            if not queue:
                near = [q for p in (-1, 0, 1) for r in (-1, 0, 1) if (q := waiting.get((x + p, y + r)))]
                if not near:
                    continue
                queue = min(near, key=lambda q: q[0])
            j = queue.popleft()
            out += [(ids[i], j, x, y), (j, ids[i], y, x)]
    return pd.DataFrame(out, columns=["synapse_id", "afferent_junction_id", "out_segment", "in_segment"], dtype="int64")


def match_reciprocal(df: DataFrame) -> DataFrame:
    """Edges that have a partner in the other direction, with the ids of both as junction ids.

    Partners have swapped sections, and segments equal or at most one apart; both get the places of the one from the lower node. Unmatched
    edges and edges from a node to itself go. An edge never meets one with other sections, so edges are dealt by pair of nodes and of
    sections, and a task holds the ids and segments of one such place at a time; all other columns are joined again by id.
    """
    forward = F.col("src") < F.col("dst")
    swap = lambda a, b: F.when(forward, F.col(a)).otherwise(F.col(b))
    slim = df.where("src <> dst").select(
        "synapse_id", forward.alias("forward"), F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"),
        swap("efferent_section_id", "afferent_section_id").alias("s1"), swap("afferent_section_id", "efferent_section_id").alias("s2"),
        swap("efferent_segment_id", "afferent_segment_id").alias("g1"), swap("afferent_segment_id", "efferent_segment_id").alias("g2"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, _MIRROR):
            yield _pairs_of(rows)

    by_place = slim.repartition(*_MIRROR).sortWithinPartitions(*_MIRROR, "forward", "synapse_id")
    found = by_place.mapInPandas(run, "synapse_id long, afferent_junction_id long, out_segment long, in_segment long")
    types = dict(df.dtypes)
    segments = {"efferent_segment_id": F.col("out_segment").cast(types["efferent_segment_id"]), "afferent_segment_id": F.col("in_segment").cast(types["afferent_segment_id"])}
    joined = df.drop("efferent_junction_id", "afferent_junction_id").join(dealt(found), "synapse_id").withColumns({**segments, "efferent_junction_id": F.col("synapse_id")})
    return joined.select(*[c for c in df.columns if c not in ("efferent_junction_id", "afferent_junction_id")], "efferent_junction_id", "afferent_junction_id")


def last_near(enter: np.ndarray, leave: np.ndarray, away: np.ndarray, last: np.ndarray, reach: float) -> np.ndarray:
    """For each place of one connection the largest `last` of the places on its section or below it (enter within enter..leave) that are nearer than reach.

    All places start open. A segment tree over the order of enter holds a place at the few nodes that make up its interval, sorted by distance.
    Taking the places from the largest `last` down, each closes all open ones over it within reach: the nodes from its leaf to the root, a range of
    each. What is closed is skipped for good, so an entry is passed once.
    """
    found = np.full(len(enter), -1, np.int64)
    known = np.unique(enter)
    n = len(known)
    low, high = np.searchsorted(known, enter), np.searchsorted(known, leave, "right")
    entries: dict[int, list[int]] = defaultdict(list)
    for i, (a, b) in enumerate(zip((low + n).tolist(), (high + n).tolist(), strict=True)):
        while a < b:
            if a & 1:
                entries[a].append(i)
                a += 1
            if b & 1:
                b -= 1
                entries[b].append(i)
            a, b = a >> 1, b >> 1
    nodes = {}
    for node, own in entries.items():
        order = np.array(own)[np.argsort(away[own], kind="stable")]
        # where the next open entry is; one more that is never closed ends the walk
        nodes[node] = (away[order].tolist(), order.tolist(), list(range(len(own) + 1)))
    distance, places = away.tolist(), low.tolist()
    for q in np.argsort(-last, kind="stable").tolist():
        d, node = distance[q], places[q] + n
        while node:
            if node in nodes:
                far, own, onward = nodes[node]
                k = bisect_left(far, d - reach)
                while True:
                    root = k
                    while onward[root] != root:
                        root = onward[root]
                    while onward[k] != root:
                        onward[k], k = root, onward[k]
                    k = root
                    if k == len(own) or far[k] > d + reach:
                        break
                    if abs(far[k] - d) < reach:
                        if found[own[k]] < 0:
                            found[own[k]] = last[q]
                        onward[k] = k + 1
                    k += 1
            node >>= 1
    return found


def prune_near_root(df: DataFrame, intervals: DataFrame, distances: DataFrame, radii: DataFrame, factor: float = 3.0) -> DataFrame:
    """Drop edges at a root that lie near a later edge on the same branch.

    Edges without an end in section 0 pass. Of a connection that starts with such an edge into the
    root, an edge drops if a later one lies on its section or one that descends from it, and their distances to
    the root differ by less than factor times the radius; edges whose place has none of these neither drop nor make others drop. The partner
    of a kept edge is kept, wherever it is. intervals(morphology, section_id, enter, leave), distances(morphology, section_id, idx, root_distance).

    Whether an edge drops depends on later edges, not on whether these stay. So of all edges of a place only the last one can stay, and a
    connection comes down to the places that it touches, at most the segments of a morphology, before it meets in one task.
    """
    at_root = (F.col("efferent_section_id") == 0) | (F.col("afferent_section_id") == 0)
    touched = df.where(at_root)
    labels = distances.join(dealt(intervals), ["morphology", "section_id"]).join(dealt(radii), "morphology").select(
        F.col("morphology").alias("src_morphology"), F.col("section_id").alias("efferent_section_id"), F.col("idx").alias("efferent_segment_id"),
        F.col("enter").alias("__enter"), F.col("leave").alias("__leave"), F.col("root_distance").alias("__away"), (F.col("radius") * factor).alias("__reach"),
    )
    slim = touched.select("src", "dst", "synapse_id", "src_morphology", "efferent_section_id", "efferent_segment_id", "afferent_section_id", "efferent_junction_id", "afferent_junction_id")
    starts = slim.groupBy("src", "dst").agg(F.min_by("afferent_section_id", "synapse_id").alias("__into")).where("__into = 0").select("src", "dst")
    known = slim.join(dealt(labels), ["src_morphology", "efferent_section_id", "efferent_segment_id"], "left").join(dealt(starts), ["src", "dst"], "left_semi")
    judged = F.coalesce((F.col("__reach") > 0) & ~F.isnan("__away") & ~F.isnan("__reach"), F.lit(False))
    both = ["efferent_junction_id", "afferent_junction_id"]
    spots = known.where(judged).groupBy("src", "dst", "__enter", "__leave", "__away", "__reach").agg(F.max(F.struct("synapse_id", *both)).alias("__last"))
    spots = spots.select("src", "dst", "__enter", "__leave", "__away", "__reach", F.col("__last.synapse_id").alias("synapse_id"), *[F.col(f"__last.{c}").alias(c) for c in both])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, ["src", "dst"]):
            cuts = np.flatnonzero((rows[["src", "dst"]] != rows[["src", "dst"]].shift()).any(axis=1).to_numpy())
            enter, leave, away, reach, last = (rows[c].to_numpy() for c in ("__enter", "__leave", "__away", "__reach", "synapse_id"))
            stays = np.empty(len(rows), bool)
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(rows)], strict=True):
                stays[a:b] = last_near(enter[a:b], leave[a:b], away[a:b], last[a:b], float(reach[a])) == last[a:b]
            yield rows.loc[stays, both]

    kept = spots.repartition("src", "dst").sortWithinPartitions("src", "dst").mapInPandas(run, "efferent_junction_id long, afferent_junction_id long")
    kept = kept.unionByName(known.where(~judged).select(*both))
    ids = kept.select(F.explode(F.array(*both)).alias("efferent_junction_id")).distinct()
    return df.where(~at_root).unionByName(touched.join(dealt(ids), "efferent_junction_id", "left_semi").select(*df.columns))


def nearest_value_join(df: DataFrame, library: DataFrame, column: str, value: str, index: str, into: str, most_literals: int = MOST_LITERALS) -> DataFrame:
    """df with the library index whose value is nearest; on a tie, or for equal values, the lowest index. Null for null.

    A library of at most MOST_LITERALS values becomes an expression, halved at the middle of its values at each step, so df is not
    shuffled. A larger one meets the distinct values of the column in one order, where each takes the values before and after it.
    """
    distinct = library.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(index).alias(index))
    known = sorted(tuple(r) for r in distinct.select(value, index).limit(most_literals + 1).collect())
    x = F.col(column)
    if not known:
        return df.withColumn(into, F.lit(None).cast(dict(library.dtypes)[index]))
    if len(known) <= most_literals:
        return df.withColumn(into, F.when(x.isNotNull(), _nearest(known, x)))
    rows = distinct.select(F.col(value).alias("x"), F.col(value).alias("own")).unionByName(df.select(x.cast("double").alias("x")).where("x IS NOT NULL").distinct().withColumn("own", F.lit(None).cast("double")))
    low = running(rows, ["x"], "own", "low", F.max).select("x", "low").distinct()
    high = running(rows.selectExpr("-x AS x", "-own AS own"), ["x"], "own", "high", F.max).selectExpr("-x AS x", "-high AS high").distinct()
    # equal values lie in one range, and each has the value itself on one side at least
    sides = low.groupBy("x").agg(F.max("low").alias("low")).join(high.groupBy("x").agg(F.min("high").alias("high")), "x", "full")
    for side in ("low", "high"):
        sides = sides.join(distinct.select(F.col(value).alias(side), F.col(index).alias(f"{side}_index")), side, "left")
    down, up = F.col("x") - F.col("low"), F.col("high") - F.col("x")
    nearer = F.when(up.isNull() | (down < up), F.col("low_index")).when(down.isNull() | (up < down), F.col("high_index")).otherwise(F.least("low_index", "high_index"))
    found = sides.select(F.col("x").alias(column), nearer.alias(into))
    return df.join(found.withColumn(column, F.col(column).cast(dict(df.dtypes)[column])), column, "left").select(*df.columns, into)


def _nearest(known: list[tuple[float, int]], x: Column) -> Column:
    """The index of the nearest of sorted (value, index) pairs: a tree of comparisons with the middles between neighbours."""
    if len(known) == 1:
        return F.lit(known[0][1])
    k = len(known) // 2
    (low, i), (high, j) = known[k - 1], known[k]
    # at a midpoint the lower index wins
    down, up = x - F.lit(low), F.lit(high) - x
    return F.when((down <= up) if i < j else (down < up), _nearest(known[:k], x)).otherwise(_nearest(known[k:], x))


def assign_spines(df: DataFrame, library: DataFrame, unassigned: Column | None = None) -> DataFrame:
    """df with spine_morphology, spine_psd_id and spine_sharing_id from the spine of the nearest length."""
    if unassigned is None:
        unassigned = (F.col("syn_type_id") == 0) | (F.col("src_morph_class") == "INT")
    found = nearest_value_join(df, library, "spine_length", "spine_length", "spine_index", "__spine")
    names = library.select(F.col("spine_index").alias("__spine"), F.col("spine_morphology").alias("__name"), F.col("spine_psd_id").alias("__psd"))
    joined = found.join(names, "__spine", "left")
    out = joined.withColumns({"spine_morphology": F.when(unassigned, "").otherwise(F.col("__name")), "spine_psd_id": F.when(unassigned, -1).otherwise(F.col("__psd")), "spine_sharing_id": F.lit(-1)})
    return out.drop("__spine", "__name", "__psd")
