"""Every query of the edge operators against its SQL, and properties where SQL can't say it."""

import collections
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from edgeworks.plans import registry
from edgeworks.sources import fixtures as fx

ROOT = Path(__file__).resolve().parents[1]


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_equals_sql(spark, sf_dir, duck, name):
    df = registry.QUERIES[name](spark, sf_dir)
    found = duck.execute(registry.ORACLES[name])
    names = [c[0] for c in found.description]
    expected = found.fetchall()
    assert sorted(df.columns) == sorted(names)
    got, want = rows_of(df.columns, [tuple(r) for r in df.collect()]), rows_of(names, expected)
    assert len(got) == len(want) > 0
    for a, b in zip(got, want, strict=True):
        assert a == pytest.approx(b, abs=2e-6, nan_ok=True) if all(isinstance(x, (int, float)) for x in (*a, *b)) else a == b


def test_draws_follow_their_distributions(spark, sf_dir):
    from pyspark.sql import functions as F

    gamma = registry.QUERIES["keyed_gamma"](spark, sf_dir).agg(F.avg("x"), F.stddev("x")).first()
    assert gamma[0] == pytest.approx(0.33, rel=0.05) and gamma[1] == pytest.approx(0.28, rel=0.07)
    normal = registry.QUERIES["keyed_trunc_normal"](spark, sf_dir).agg(F.min("x"), F.max("x"), F.avg("x")).first()
    assert normal[0] >= 0.12 and normal[1] <= 0.38 and normal[2] == pytest.approx(0.25, rel=0.02)
    poisson = registry.QUERIES["keyed_poisson"](spark, sf_dir).agg(F.min("x"), F.avg("x"), F.variance("x")).first()
    assert poisson[0] == 1 and poisson[1] == pytest.approx(3.5, rel=0.03) and poisson[2] == pytest.approx(2.5, rel=0.08)


def test_connections_have_one_property_set(spark, sf_dir):
    df = registry.QUERIES["connection_properties"](spark, sf_dir).toPandas()
    names = [c for c in df.columns if c not in ("src", "dst", "synapse_id")]
    assert (df.groupby(["src", "dst"])[names].nunique() == 1).all().all()
    assert (df["u_syn"] >= 0).all() and (df["conductance"] > 0).all() and (df["n_rrp_vesicles"] >= 1).all()


def test_gap_junctions_come_in_pairs(spark, sf_dir):
    df = registry.QUERIES["gap_junction"](spark, sf_dir).toPandas()
    assert len(df) and df["efferent_junction_id"].is_unique and df["afferent_junction_id"].is_unique
    partner = df.set_index("efferent_junction_id")["afferent_junction_id"]
    assert all(partner[b] == a for a, b in partner.items())


def plain_junctions(duck):
    """Greedy matching and pruning, pair by pair and connection by connection, in the order of ids."""
    rows = [dict(zip([c[0] for c in found.description], r, strict=True)) for found in [duck.execute(fx.with_sql("redges") + "SELECT * FROM redges ORDER BY synapse_id")] for r in found.fetchall()]
    above, away = collections.defaultdict(set), {}
    for m, s, a, _ in duck.execute(fx.with_sql("above") + "SELECT morphology, section_id, ancestor_id, depth FROM above").fetchall():
        above[m, s].add(a)
    for m, s, i, d in duck.execute(fx.with_sql("rootdist") + "SELECT * FROM rootdist").fetchall():
        away[m, s, i] = d
    radius = dict(duck.execute(fx.with_sql("radii") + "SELECT * FROM radii").fetchall())
    ways = collections.defaultdict(list)
    for r in rows:
        ways[r["src"], r["dst"]].append(r)
    matched = []
    for (a, b), forward in sorted(ways.items()):
        left = list(ways.get((b, a), ())) if a < b else []
        for i in forward if left else ():
            mirrored = [j for j in left if i["efferent_section_id"] == j["afferent_section_id"] and i["afferent_section_id"] == j["efferent_section_id"]]
            gap = lambda j, i=i: max(abs(i["efferent_segment_id"] - j["afferent_segment_id"]), abs(i["afferent_segment_id"] - j["efferent_segment_id"]))
            found = next((j for j in mirrored if gap(j) == 0), next((j for j in mirrored if gap(j) == 1), None))
            if found:
                left.remove(found)
                found.update(efferent_segment_id=i["afferent_segment_id"], afferent_segment_id=i["efferent_segment_id"])
                i["partner"], found["partner"] = found["synapse_id"], i["synapse_id"]
                matched += [i, found]
    at_root = [r for r in matched if 0 in (r["efferent_section_id"], r["afferent_section_id"])]
    connections, kept = collections.defaultdict(list), set()
    for r in sorted(at_root, key=lambda r: r["synapse_id"]):
        connections[r["src"], r["dst"]].append(r)
    for own in connections.values():
        active = []
        for i in own if own[0]["afferent_section_id"] == 0 else ():
            m = f"M{i['src']}"
            place = lambda r, m=m: away.get((m, r["efferent_section_id"], r["efferent_segment_id"]), float("nan"))
            active = [j for j in active if not (j["efferent_section_id"] in above[m, i["efferent_section_id"]] and abs(place(i) - place(j)) < 3 * radius.get(m, float("nan")))]
            active.append(i)
        kept |= {x for r in active for x in (r["synapse_id"], r["partner"])}
    return {(r["synapse_id"], r["partner"]) for r in matched if r not in at_root or r["synapse_id"] in kept}


def test_gap_junctions_against_plain(spark, sf_dir, duck):
    rows = registry.QUERIES["gap_junction"](spark, sf_dir).collect()
    want = plain_junctions(duck)
    assert {(r["efferent_junction_id"], r["afferent_junction_id"]) for r in rows} == want and len(rows) == len(want) > 50
    assert all(r["synapse_id"] == r["efferent_junction_id"] and r["conductance"] == 0.75 for r in rows)


def test_provenance(spark, sf_dir):
    rows = {r["key"]: r["value"] for r in registry.QUERIES["provenance_table"](spark, sf_dir).collect()}
    assert rows["run2_operators"] == "edge_merge" and rows["source_population_size"] == "10"


def test_event_log(spark, sf_dir, duck):
    row = registry.QUERIES["eventlog_metrics"](spark, sf_dir).first()
    n, price = duck.execute("SELECT max(n), CAST(max(floor(p)) AS BIGINT) FROM (SELECT count(*) n, sum(l_extendedprice) p FROM lineitem GROUP BY l_orderkey)").fetchone()
    assert row["max_rows"] == n and abs(row["max_shuffle"] - price) <= 1


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(registry.ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_rest_stands_without_the_corpus_part(tmp_path, pipeline):
    """The entry imports, and registers its queries, in a copy without the folders of the corpus operators."""
    copy = shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"])))
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert 'pathway_stats' in q and o.keys() <= q.keys() and 'pipeline' not in q and not any(n.startswith('op') for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True)
