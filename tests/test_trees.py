"""Trees of sections by pointer jumping, and what gap junctions do with them, against plain walks."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from edgeworks.operators import geometry, matching, model, properties
from edgeworks.sources import fixtures as fx

SECTION = "morphology string, section_id int, parent_id int, type int"


@pytest.fixture(scope="module")
def forest():
    rng = random.Random(1)
    rows = []
    for m in range(12):
        order = list(range(100))
        rng.shuffle(order)
        rows += [(f"M{m}", i, order[rng.randrange(k)] if k else None, 1) for k, i in enumerate(order[: rng.randint(1, 60)])]
    rows += [("chain", k, k - 1 if k else None, 1) for k in range(70)]
    # two roots, and a parent that is not there
    return rows + [("two", 0, None, 1), ("two", 5, None, 1), ("two", 6, 5, 1), ("two", 7, 0, 1), ("missing", 1, 99, 1), ("missing", 2, 1, 1)]


def ways(rows):
    """The sections above each, by walking up."""
    parent = {(m, s): p for m, s, p, _ in rows}
    out = {}
    for m, s in parent:
        way, at = [], parent[m, s]
        while (m, at) in parent:
            way.append(at)
            at = parent[m, at]
        out[m, s] = way
    return out


def test_sums_sizes_and_intervals(spark, forest):
    df, up = spark.createDataFrame(forest, SECTION), ways(forest)
    got = {(r["morphology"], r["section_id"]): r["v"] for r in geometry.path_sums(df.withColumn("v", F.col("section_id") + 1), "v").collect()}
    assert got == {(m, s): sum(a + 1 for a in way) for (m, s), way in up.items()}
    sizes = dict.fromkeys(up, 1)
    for (m, _), way in up.items():
        for a in way:
            sizes[m, a] += 1
    assert {(r["morphology"], r["section_id"]): r["size"] for r in geometry.subtree_sizes(df).collect()} == sizes
    found = {(r["morphology"], r["section_id"]): (r["enter"], r["leave"]) for r in geometry.section_intervals(df).collect()}
    for m, s in up:
        for m2, a in up:
            if m == m2:
                assert (found[m, a][0] <= found[m, s][0] <= found[m, a][1]) == (a == s or a in up[m, s])


def test_a_long_chain_stays_one_row_a_section(spark):
    n = 10_000
    sections = spark.createDataFrame([("M", k, k - 1 if k else None, 1) for k in range(n)], SECTION)
    points = spark.createDataFrame([("M", k, i, float(k + i), 0.0, 0.0) for k in range(n) for i in (0, 1)], "morphology string, section_id int, idx int, x double, y double, z double")
    found = geometry.root_distances(sections, points).orderBy("section_id", "idx").collect()
    # the root is the body and does not count
    assert len(found) == 2 * n and all(r["root_distance"] == max(0, r["section_id"] - 1) + r["idx"] for r in found)


def test_cycles_are_an_error(spark):
    rows = [("M", 0, 1, 1), ("M", 1, 0, 1), ("N", 0, None, 1)]
    with pytest.raises(ValueError, match="cycle"):
        geometry.path_sums(spark.createDataFrame(rows, SECTION).withColumn("v", F.lit(1)), "v")
    with pytest.raises(ValueError, match="cycle"):
        geometry.subtree_sizes(spark.createDataFrame(rows, SECTION))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SECTION)
    assert geometry.section_intervals(empty).count() == 0 and geometry.subtree_sizes(empty).count() == 0


def _near(enter, leave, away, last, reach):
    """The same by comparing all pairs."""
    over = (enter[:, None] <= enter[None, :]) & (enter[None, :] <= leave[:, None]) & (np.abs(away[:, None] - away[None, :]) < reach)
    return np.where(over, last[None, :], -1).max(axis=1)


@pytest.mark.parametrize("steps", [1.0, 0.25])
def test_last_near_against_all_pairs(forest, steps):
    rng = np.random.default_rng(3)
    up = ways(forest)
    for trial in range(60):
        m = f"M{trial % 12}"
        own = sorted(s for x, s in up if x == m)
        walk = sorted(own, key=lambda s: [*reversed(up[m, s]), s])
        enter = {s: k for k, s in enumerate(walk)}
        leave = {s: max(enter[x] for x in own if x == s or s in up[m, x]) for s in own}
        n = int(rng.integers(1, 80))
        pick = rng.choice(own, n)
        e, lv = np.array([enter[s] for s in pick]), np.array([leave[s] for s in pick])
        away = np.round(rng.random(n) * 10 / steps) * steps
        last = rng.permutation(n * 3)[:n].astype(np.int64)
        for reach in (1.0, 3.0, 100.0):
            assert (matching.last_near(e, lv, away, last, reach) == _near(e, lv, away, last, reach)).all()


def test_many_places_of_one_connection_take_seconds():
    n = 100_000
    rng = np.random.default_rng(4)
    enter = rng.integers(0, 10_000, n)
    leave = np.minimum(9_999, enter + rng.integers(0, 3_000, n))
    began = time.perf_counter()
    found = matching.last_near(enter, leave, rng.random(n) * 1000, rng.permutation(n), 5.0)
    assert time.perf_counter() - began < 60 and (found >= 0).all()


def test_a_hot_pair_is_dealt_by_its_sections(spark):
    """Two nodes with all edges: as many groups as pairs of sections, not one."""
    df = spark.range(40_000).selectExpr("IF(id % 2 = 0, 1L, 2L) AS src", "IF(id % 2 = 0, 2L, 1L) AS dst", "id AS synapse_id", "CAST(IF(id % 2 = 0, id div 2 % 97, id div 2 % 89) AS INT) AS efferent_section_id", "CAST(id % 5 AS INT) AS efferent_segment_id", "CAST(IF(id % 2 = 0, id div 2 % 89, id div 2 % 97) AS INT) AS afferent_section_id", "CAST(id % 3 AS INT) AS afferent_segment_id")
    found = matching.match_reciprocal(df)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [a#") == 1 and "s1#" in plan.split("RepartitionByExpression", 1)[1].split("]", 1)[0]
    rows = {r["synapse_id"]: r for r in found.collect()}
    assert rows and all(rows[r["afferent_junction_id"]]["afferent_junction_id"] == i for i, r in rows.items())


def test_equal_places_of_a_hot_connection_are_combined_first(spark):
    """Ten thousand edges at one place and one farther out: the last of each stays where nothing later is near."""
    edges = spark.range(10_000).selectExpr("1L AS src", "2L AS dst", "id AS synapse_id", "3 AS efferent_section_id", "0 AS efferent_segment_id", "0 AS afferent_section_id", "0 AS afferent_segment_id", "id AS efferent_junction_id", "id + 100000 AS afferent_junction_id", "'M' AS src_morphology")
    edges = edges.unionByName(spark.createDataFrame([(1, 2, 20_000, 9, 0, 0, 0, 20_000, 120_000, "M")], edges.schema))
    intervals = spark.createDataFrame([("M", 3, 1, 2), ("M", 9, 3, 3)], "morphology string, section_id int, enter long, leave long")
    distances = spark.createDataFrame([("M", 3, 0, 5.0), ("M", 9, 0, 5.5)], "morphology string, section_id int, idx int, root_distance double")
    radii = spark.createDataFrame([("M", 1.0)], "morphology string, radius double")
    kept = matching.prune_near_root(edges, intervals, distances, radii)
    assert sorted(r["synapse_id"] for r in kept.collect()) == [9_999, 20_000]


def test_trees_are_never_broadcast(spark, sf_dir, monkeypatch):
    """Files of sections pack so well, and exploded rows are estimated so low, that a broadcast by Spark's estimate holds a whole forest in the driver."""
    plans = []

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    written, checkpoint = geometry.written, geometry.checkpoint
    monkeypatch.setattr(geometry, "written", lambda df, **metrics: written(planned(df), **metrics))
    monkeypatch.setattr(geometry, "checkpoint", lambda df: checkpoint(planned(df)))
    sections, points = fx.sections(spark, sf_dir), fx.points(spark, sf_dir)
    for found in (geometry.section_intervals(sections), geometry.root_distances(sections, points), geometry.root_radii(sections, points), geometry.first_section(sections, points, 1), geometry.ancestors(sections)):
        planned(found)
    assert len(plans) > 10 and not [p for p in plans if "BroadcastExchange" in p]


def test_what_grows_is_not_broadcast_to_edges(spark, sf_dir, monkeypatch):
    """Radii, places on axons, intervals and distances have a row a morphology or more; node tables over MOST_SENT rows are dealt too."""
    text = lambda df: df._jdf.queryExecution().executedPlan().toString()
    edges = spark.range(100).selectExpr("id AS src", "id AS dst", "id AS synapse_id", "concat('M', id) AS src_morphology", "concat('M', id) AS dst_morphology", "1.0D AS distance_soma", "0 AS efferent_section_id", "0 AS efferent_segment_id", "0 AS afferent_section_id", "0 AS afferent_segment_id", "id AS efferent_junction_id", "id AS afferent_junction_id", "0 AS code")
    many = spark.range(1000).selectExpr("concat('M', id) AS morphology", "0 AS section_id", "0 AS idx", "1.0D AS radius", "1.0D AS root_distance", "0L AS enter", "0L AS leave", "0.5D AS offset", "0.5D AS fraction", "id")
    moved = properties.reposition(edges, spark.range(0).selectExpr("0 AS code"), ["code"], many)
    # only the table of the pathways that move is small
    assert text(moved).count("BroadcastExchange") == 1
    assert "BroadcastExchange" not in text(properties.min_distance_by_key(edges, many.select("morphology", "radius")))
    places = many.select("morphology", "section_id", "idx", "root_distance"), many.select("morphology", "radius")
    assert "BroadcastExchange" not in text(matching.prune_near_root(edges, many.select("morphology", "section_id", "enter", "leave"), *places))
    assert "BroadcastExchange" not in text(matching.match_reciprocal(edges))
    few, nodes = spark.range(10).selectExpr("id", "'a' AS x"), many.select("id", "morphology")
    monkeypatch.setattr(model, "MOST_SENT", 999)
    assert text(model.assemble(edges.select("src", "dst", "synapse_id"), few, nodes)).count("BroadcastExchange") == 1
