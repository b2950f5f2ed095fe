"""Named nodesets, footers, overlaps of inputs, and metadata at rest."""

import json

import pytest
from pyspark.sql import functions as F

from edgeworks.plans import pipeline
from edgeworks.sources import nodesets, tables

EDGES = "src long, dst long, synapse_id long, afferent_section_type int, efferent_section_type int"


@pytest.fixture(scope="module")
def nodes(spark):
    return spark.createDataFrame([(0, 1, "L1"), (1, 2, "L2"), (2, None, "L2"), (3, 1, None), (4, 9, "X")], "id long, region int, layer string")


SETS = {"one": {"region": 1}, "some": {"region": [2, 9]}, "both": {"region": 1, "layer": "L1"}, "ids": {"node_id": [2, 3]}, "none": {"region": []}, "all": {}, "high": {"region": {"$gt": 1, "$lte": 9}}, "named": {"layer": {"$regex": "L[0-9]"}}, "union": ["one", "some"], "deep": ["union", "ids", "one"], "loop": ["deep", "back"], "back": ["loop"], "lost": ["nowhere"], "odd": {"colour": 1}, "worse": {"region": {"$near": 1}}}


@pytest.mark.parametrize(("name", "ids"), [("one", [0, 3]), ("some", [1, 4]), ("both", [0]), ("ids", [2, 3]), ("none", []), ("all", [0, 1, 2, 3, 4]), ("high", [1, 4]), ("named", [0, 1, 2]), ("union", [0, 1, 3, 4]), ("deep", [0, 1, 2, 3, 4])])
def test_nodesets(nodes, name, ids):
    assert sorted(r["id"] for r in nodesets.named_nodes(nodes, SETS, name).collect()) == ids


@pytest.mark.parametrize(("name", "what"), [("loop", "cycle"), ("lost", "no nodeset 'nowhere'"), ("odd", "no attribute 'colour'"), ("worse", "no comparison"), ("missing", "no nodeset")])
def test_nodesets_that_cannot_be(nodes, name, what):
    with pytest.raises(ValueError, match=what):
        nodesets.named_nodes(nodes, SETS, name)


def test_nodesets_of_a_file_and_their_cache(spark, nodes, tmp_path):
    (tmp_path / "sets.json").write_text(json.dumps(SETS, indent=1))
    assert nodesets.read_nodesets(spark, str(tmp_path / "sets.json")) == SETS
    path = str(tmp_path / "nodes")
    nodes.write.parquet(path)
    assert tables.cached_nodes(spark, path, str(tmp_path), "union", SETS).count() == 4
    # what a set comes down to is part of the cache's name
    assert tables.cached_nodes(spark, path, str(tmp_path), "union", {**SETS, "some": {"region": 2}}).count() == 3


def test_codes_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "codes")
    spark.createDataFrame([(1, 1, 1, 1, 4), (1, 1, 2, 3, 2)], EDGES).withColumnsRenamed({"src": "source_node_id", "afferent_section_type": "post_branch_type"}).write.parquet(path)
    df, present = tables.footer_frame(spark, path, list(tables.CODES))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert present == list(tables.CODES) and "PushedAggregation: [MIN(" in plan.replace("\n", " ")
    ranges = tables.footer_ranges(spark, path, list(tables.CODES))
    assert ranges == {"afferent_section_type": (1, 3), "efferent_section_type": (2, 4)} and tables.base_of(ranges) == 1
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    found, _ = tables.load_edges(spark, [path], renames={})
    assert sorted((r["afferent_section_type"], r["efferent_section_type"]) for r in found.collect()) == [(0, 3), (2, 1)]


def test_codes_of_empty_tables_stay(spark, tmp_path):
    empty = spark.createDataFrame([], EDGES)
    assert tables.code_base(empty, list(tables.CODES)) == 0
    empty.write.parquet(str(tmp_path / "empty"))
    assert tables.load_edges(spark, [str(tmp_path / "empty")])[0].count() == 0
    assert tables.base_of({}) == 0
    with pytest.raises(ValueError):
        tables.base_of({"a": (1, 2), "b": (None, None)})


def _written(spark, tmp_path, parts):
    """Inputs of several files each; an edge is (dst, synapse_id)."""
    paths = []
    for k, files in enumerate(parts):
        path = str(tmp_path / f"in{k}")
        paths.append(path)
        for rows in files:
            spark.createDataFrame([(1, d, i, 1, 1) for d, i in rows], EDGES).coalesce(1).write.mode("append").parquet(path)
    return paths


CASES = [
    ([[[(1, 1), (5, 2)]], [[(6, 2), (9, 3)]]], []),
    ([[[(1, 1), (5, 2)]], [[(5, 2), (9, 3)]]], [(2, [0, 1])]),
    ([[[(1, 1), (9, 9)]], [[(4, 4), (5, 5)]], [[(5, 5), (9, 9)]]], [(5, [1, 2]), (9, [0, 2])]),
    ([[[(1, 1)], [(3, 3), (7, 7)]], [[(2, 2), (3, 3)], [(7, 7), (8, 8)]]], [(3, [0, 1]), (7, [0, 1])]),
    ([[[(1, 1), (1, 1)]], [[(1, 2)]]], []),
    ([[[(10, 1), (20, 2)]], [[(15, 3)]], [[(12, 4), (18, 5)]], [[(15, 3), (30, 6)]]], [(3, [1, 3])]),
]


@pytest.mark.parametrize(("parts", "want"), CASES)
def test_overlaps(spark, tmp_path, parts, want):
    paths = _written(spark, tmp_path, parts)
    assert sorted((r["synapse_id"], r["inputs"]) for r in tables.overlaps(spark, paths).collect()) == want


def test_overlaps_against_all_edges(spark, tmp_path):
    import random

    rng = random.Random(2)
    parts = [[[(rng.randrange(a, a + w), rng.randrange(3)) for _ in range(6)] for a, w in ((rng.randrange(60), rng.randrange(1, 15)) for _ in range(3))] for _ in range(4)]
    held = {}
    for k, files in enumerate(parts):
        for rows in files:
            for edge in rows:
                held.setdefault(edge, set()).add(k)
    found = {((r["dst"], r["synapse_id"])): set(r["inputs"]) for r in tables.overlaps(spark, _written(spark, tmp_path, parts)).collect()}
    assert found == {e: k for e, k in held.items() if len(k) > 1}


def test_overlaps_put_ranges_together_and_need_several_words(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "RANGES", 2, raising=False)
    monkeypatch.setattr(tables, "WORD_INPUTS", 2, raising=False)
    parts = [[[(k, k), (k + 5, k + 5)] for k in range(0, 40, 10)], [[(k, k) for k in (5, 17, 25, 36)]], [[(5, 5), (36, 9)]], [[(25, 25)], [(99, 99)]], [[(5, 5)]]]
    found = tables.overlaps(spark, _written(spark, tmp_path, parts))
    assert sorted((r["synapse_id"], r["inputs"]) for r in found.collect()) == [(5, [0, 1, 2, 4]), (25, [0, 1, 3])]
    # no set of objects, and no join by the names of files: what rows are compared the scan knows
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "Join" not in plan


def test_merge_refuses_what_overlaps(spark, tmp_path):
    paths = _written(spark, tmp_path, [[[(1, 1), (5, 2)]], [[(5, 2)]]])
    with pytest.raises(ValueError, match="overlap"):
        pipeline.merge(spark, paths, str(tmp_path / "out"))


def test_populations_of_columns_are_read(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, 0, 1, 2)], EDGES)
    tables.export(df, str(tmp_path / "a"), metadata={"source_population_name": "A", "source_population_size": "7", "x": "y"})
    # the files alone, without the table beside them
    spark.read.parquet(str(tmp_path / "a")).write.parquet(str(tmp_path / "b"))
    assert tables.read_metadata(spark, str(tmp_path / "b")) == {"source_population_name": "A", "source_population_size": "7"}
    assert tables.read_metadata(spark, str(tmp_path / "a"))["x"] == "y"


def test_steps_are_counted_where_they_are_written(spark, tmp_path):
    """A step that must keep all rows is held against the state before it, without another run of either."""
    calls = spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: calls.add(1) or x, "long")
    steps = [
        pipeline.Step("cut", lambda df: df.where(count("synapse_id") >= 0), None, checkpoint=True),
        pipeline.Step("keep", lambda df: df.withColumn("v", F.lit(1)), None, added=frozenset({"v"}), reductive=False, checkpoint=True),
        pipeline.Step("lose", lambda df: df.where("synapse_id > 3"), None, reductive=False, checkpoint=True),
    ]
    edges = lambda: spark.range(100).withColumnRenamed("id", "synapse_id")
    assert pipeline.run(spark, edges, "in", steps[:2], str(tmp_path)).count() == 100
    assert calls.value == 100
    with pytest.raises(ValueError, match="lose must keep"):
        pipeline.run(spark, edges, "in", steps, str(tmp_path))


def test_files_are_counted_by_rows(spark, tmp_path):
    """Rows that pack well fill a file by their number, not by their bytes."""
    many, few, small = (str(tmp_path / x) for x in ("many", "few", "small"))
    spark.range(10_000_001).write.parquet(many)
    assert len(tables.compact(spark, many, few).inputFiles()) == 2
    spark.range(21).write.parquet(small)
    for rows, files in ((10, 3), (7, 3), (20, 2), (21, 1)):
        found = tables.compact(spark, small, f"{small}-{rows}", file_rows=rows)
        assert len(found.inputFiles()) == files and sorted(r[0] for r in found.collect()) == list(range(21))
