"""The registered queries of the edge operators, with their SQL.

Computed doubles are rounded to six places on both sides, since sums differ in their last digits
between engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeworks.functions.bins import value_bins
from edgeworks.functions.random import keyed_counter, keyed_gamma, keyed_poisson, keyed_trunc_normal, keyed_uniform
from edgeworks.operators import geometry, ids, matching, model, properties, quality, rules, sampling
from edgeworks.sources import fixtures as fx
from edgeworks.sources import nodesets, tables
from edgeworks.sources.checkpoint import temporary, written

from . import pipeline

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *needs: str):
    """Register a function under its name, with SQL after a WITH clause of what it needs."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = (fx.with_sql(*needs) if needs else "") + sql
        return function

    return add


def r6(column: Column | str) -> Column:
    return F.round(column, 6)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder among the shared ones, which goes when the application ends."""
    return temporary(spark, name)


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.with_pathway(fx.circuit(spark, sf_dir), *fx.PATHWAY)


def mtype_sets(spark: SparkSession, sf_dir: str, table: DataFrame) -> dict[str, DataFrame]:
    """The rules that fit each type of source and of target."""
    return rules.pattern_sets(table, {"src_mtype": fx.source_types(spark, sf_dir), "dst_mtype": fx.target_types(spark, sf_dir)})


MTYPES = {"src_mtype": "src_mtype_i", "dst_mtype": "dst_mtype_i"}


def connection_rules(spark: SparkSession, sf_dir: str, df: DataFrame) -> DataFrame:
    """The last rule that covers each pathway of df, by pathway_i."""
    table = spark.createDataFrame([*fx.CONNECTION_RULES], "rule_i int, src_mtype string, dst_mtype string, " + ", ".join(f"{c} double" for c in fx.CONNECTION_FIELDS))
    best = rules.last_rules(df, mtype_sets(spark, sf_dir, table), MTYPES).join(table.drop("src_mtype", "dst_mtype"), "rule_i")
    return best.withColumn("pathway_i", model.pathway_key(best, *fx.PATHWAY)).select("pathway_i", *fx.CONNECTION_FIELDS)


def params_of(spark: SparkSession, sf_dir: str, df: DataFrame) -> DataFrame:
    """One row a pathway, written once: each of the three steps reads them."""
    return tables.checkpointed(spark, lambda: sampling.reduce_params(model.pathway_stats(df), connection_rules(spark, sf_dir, df)), scratch(spark, "params"))


def touch_sets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    table = spark.createDataFrame([*fx.TOUCH_RULES], "rule_i int, src_mtype string, dst_mtype string, kind string")
    return rules.pattern_sets(table, {"src_mtype": fx.source_types(spark, sf_dir), "dst_mtype": fx.target_types(spark, sf_dir), "kind": fx.section_kinds(spark)})


TOUCHING = {**MTYPES, "kind": "afferent_section_type"}


def moved_pathways(spark: SparkSession, sf_dir: str, df: DataFrame) -> DataFrame:
    """The pathways of df that a rule moves."""
    table = spark.createDataFrame([*fx.REPOSITION_RULES], "rule_i int, src_mtype string, dst_mtype string")
    return rules.last_rules(df, mtype_sets(spark, sf_dir, table), MTYPES)


# -- assembly ---------------------------------------------------------------------------------


@query("SELECT * FROM circuit", "circuit")
def assemble_circuit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.circuit(spark, sf_dir)


@query("SELECT synapse_id, pathway_i, pathway_str FROM keyed", "keyed")
def pathway_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(spark, sf_dir).select("synapse_id", "pathway_i", "pathway_str")


@query("SELECT pathway_i, total_touches, total_connections, round(structural_mean, 6) AS structural_mean FROM stats", "stats")
def pathway_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.pathway_stats(keyed(spark, sf_dir)).withColumn("structural_mean", r6("structural_mean"))


@query("SELECT src, dst, synapse_id FROM edges", "edges")
def dense_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ids.dense_id(fx.raw_edges(spark, sf_dir), fx.ORDER).select("src", "dst", "synapse_id")


@query("SELECT e.src, e.dst, CAST(o.first AS BIGINT) AS synapse_id FROM edges e JOIN (SELECT src, dst, sum(n) OVER (ORDER BY src, dst) - n - 1 AS first FROM (SELECT src, dst, count(*) AS n FROM edges GROUP BY src, dst)) o ON o.src = e.src AND o.dst = e.dst", "edges")
def connection_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ids.connection_id(fx.raw_edges(spark, sf_dir)).select("src", "dst", "synapse_id")


# -- random numbers and bins ------------------------------------------------------------------


@query(f"SELECT synapse_id, round({fx.uniform_sql(fx.SEED, 0x202, 'synapse_id')}, 9) AS u FROM edges", "edges")
def keyed_uniform_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.edges(spark, sf_dir).select("synapse_id", F.round(keyed_uniform(fx.SEED, sampling.TOUCH, "synapse_id"), 9).alias("u"))


QUERIES["keyed_uniform"], ORACLES["keyed_uniform"] = QUERIES.pop("keyed_uniform_column"), ORACLES.pop("keyed_uniform_column")


@query(f"SELECT synapse_id, {fx.counter_sql(fx.SEED, 0x202, 'synapse_id')} AS u FROM edges", "edges")
def keyed_counter_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.edges(spark, sf_dir).select("synapse_id", keyed_counter(fx.SEED, sampling.TOUCH, "synapse_id").alias("u"))


QUERIES["keyed_counter"], ORACLES["keyed_counter"] = QUERIES.pop("keyed_counter_column"), ORACLES.pop("keyed_counter_column")


@query("SELECT synapse_id, CASE WHEN spine_length >= 5 THEN 5 WHEN spine_length >= 4 THEN 4 WHEN spine_length >= 3 THEN 3 WHEN spine_length >= 2 THEN 2 WHEN spine_length >= 1 THEN 1 WHEN spine_length >= 0 THEN 0 ELSE -1 END AS bin FROM edges", "edges")
def value_bin_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.edges(spark, sf_dir).select("synapse_id", value_bins(F.col("spine_length"), fx.SPINE_EDGES).alias("bin"))


QUERIES["value_bins"], ORACLES["value_bins"] = QUERIES.pop("value_bin_column"), ORACLES.pop("value_bin_column")


def _drawn(spark: SparkSession, sf_dir: str, draw) -> DataFrame:
    return fx.edges(spark, sf_dir).select("synapse_id", draw(F.col("synapse_id")).alias("x"))


@query(f"SELECT synapse_id, round({fx.gamma_sql(fx.SEED, 0x1001, 'synapse_id', '0.33::DOUBLE', '0.28::DOUBLE')}, 6) AS x FROM edges", "edges")
def keyed_gamma_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drawn(spark, sf_dir, lambda i: r6(keyed_gamma(fx.SEED, 0x1001, i, F.lit(0.33), F.lit(0.28))))


@query(f"SELECT synapse_id, round({fx.trunc_normal_sql(fx.SEED, 0x1004, 'synapse_id', '0.25::DOUBLE', '0.13::DOUBLE')}, 6) AS x FROM edges", "edges")
def keyed_trunc_normal_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _drawn(spark, sf_dir, lambda i: r6(keyed_trunc_normal(fx.SEED, 0x1004, i, F.lit(0.25), F.lit(0.13))))


@query()
def keyed_poisson_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The oracle counts the values of the distribution function that a number is above."""
    return _drawn(spark, sf_dir, lambda i: keyed_poisson(fx.SEED, 0x1006, i, F.lit(3.5)))


for _name in ("keyed_gamma", "keyed_trunc_normal", "keyed_poisson"):
    QUERIES[_name] = QUERIES.pop(f"{_name}_draws")
    if f"{_name}_draws" in ORACLES:
        ORACLES[_name] = ORACLES.pop(f"{_name}_draws")
ORACLES["keyed_poisson"] = fx.with_sql("edges").rstrip() + f", term AS (SELECT i, CAST(exp(-2.5) * 2.5 ** i / factorial(CAST(i AS INT)) AS DOUBLE) AS t FROM range(30) r(i)), below AS (SELECT list(c ORDER BY i) AS cs FROM (SELECT i, sum(t) OVER (ORDER BY i) AS c FROM term)) SELECT synapse_id, 1 + len(list_filter(cs, lambda c: c < u)) AS x FROM (SELECT synapse_id, {fx.uniform_sql(fx.SEED, 0x1006, 'synapse_id')} AS u FROM edges), below"


# -- filters ----------------------------------------------------------------------------------


@query(f"SELECT src, dst, synapse_id FROM edges WHERE {fx.uniform_sql(fx.SEED, 0x202, 'synapse_id')} <= 0.3", "edges")
def touch_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.keyed_sample(fx.edges(spark, sf_dir), 0.3, fx.SEED).select("src", "dst", "synapse_id")


@query("SELECT src, dst, synapse_id FROM circuit WHERE (distance_soma >= 5 AND dst_synapse_class_i = 1) OR (distance_soma >= 25 AND dst_synapse_class_i = 0)", "circuit")
def bouton_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return properties.class_threshold(fx.circuit(spark, sf_dir), "distance_soma", "dst_synapse_class_i", {1: 5.0, 0: 25.0}).select("src", "dst", "synapse_id")


@query("SELECT src, dst, synapse_id FROM circuit JOIN radii ON morphology = dst_morphology WHERE distance_soma >= radius", "circuit", "radii")
def soma_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    radii = geometry.root_radii(fx.sections(spark, sf_dir), fx.points(spark, sf_dir))
    return properties.min_distance_by_key(fx.circuit(spark, sf_dir), radii).select("src", "dst", "synapse_id")


@query("SELECT src, dst, synapse_id FROM circuit JOIN tcells USING (src_mtype_i, dst_mtype_i, afferent_section_type)", "circuit", "tcells")
def touch_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.allow_rules(fx.circuit(spark, sf_dir), touch_sets(spark, sf_dir), TOUCHING).select("src", "dst", "synapse_id")


@query("SELECT synapse_id, afferent_section_type, efferent_section_type, afferent_section_type + 1 AS afferent_at_rest, efferent_section_type + 1 AS efferent_at_rest FROM edges", "edges")
def code_base_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["afferent_section_type", "efferent_section_type"]
    at_rest = tables.denormalize_codes(fx.edges(spark, sf_dir), columns).selectExpr("synapse_id", *columns, "afferent_section_type AS afferent_at_rest", "efferent_section_type AS efferent_at_rest")
    return tables.normalize_codes(at_rest, columns)


@query("SELECT src, dst, synapse_id FROM circuit WHERE dst_region_i = 2 AND src_synapse_class_i = 0", "circuit")
def nodeset_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = tables.apply_nodeset(fx.source_nodes(spark, sf_dir), "synapse_class_i = 0")
    target = tables.apply_nodeset(fx.target_nodes(spark, sf_dir), "region_i = 2")
    return model.assemble(fx.edges(spark, sf_dir), source, target).select("src", "dst", "synapse_id")


#: Named sets of nodes: attributes, lists of values, comparisons, and sets of sets.
NODESETS = {
    "excitatory": {"synapse_class_i": 0},
    "outer": {"region_i": [1, 4]},
    "first": {"node_id": {"$lte": 40}},
    "large": {"mtype_i": {"$gte": 2, "$lt": 5}, "morphology": {"$regex": "M[0-9]*[13579]"}},
    "sources": ["excitatory", "first"],
    "targets": ["outer", "large"],
    "all_targets": ["targets", "outer"],
}


@query("SELECT e.src, e.dst, e.synapse_id FROM edges e JOIN srcn s ON s.id = e.src JOIN dstn d ON d.id = e.dst WHERE (s.synapse_class_i = 0 OR s.id <= 40) AND (d.region_i IN (1, 4) OR (d.mtype_i >= 2 AND d.mtype_i < 5 AND regexp_full_match(d.morphology, 'M[0-9]*[13579]')))", "edges", "srcn", "dstn")
def nodeset_compound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named sets on both sides of a run, the target's from a cache."""
    path, folder = scratch(spark, "nodes"), scratch(spark, "cache")
    fx.target_nodes(spark, sf_dir).write.parquet(path)
    source = nodesets.named_nodes(fx.source_nodes(spark, sf_dir), NODESETS, "sources")
    target = tables.cached_nodes(spark, path, folder, "all_targets", NODESETS)
    return model.assemble(fx.edges(spark, sf_dir), source, target).select("src", "dst", "synapse_id")


@query("SELECT id, morph_class, morphology, mtype_i, synapse_class_i FROM srcn", "srcn")
def node_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "nodes")
    fx.source_nodes(spark, sf_dir).selectExpr("*", "0.0 AS x", "0.0 AS rotation_angle_xaxis", "1 AS orientation_w").write.parquet(path)
    return tables.read_nodes(spark, path)


@query("SELECT src, dst, synapse_id, distance_soma FROM edges", "edges")
def edge_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two inputs with columns in different orders and under old names."""
    df = fx.edges(spark, sf_dir).select("src", "dst", "synapse_id", "distance_soma")
    first, second = scratch(spark, "edges"), scratch(spark, "edges")
    df.where("synapse_id % 2 = 0").write.parquet(first)
    df.where("synapse_id % 2 = 1").selectExpr("distance_soma AS soma_distance", "dst AS target_node_id", "synapse_id", "src AS source_node_id").write.parquet(second)
    return tables.read_edges(spark, [first, second], {"soma_distance": "distance_soma"}).select(*df.columns)


# -- reduction --------------------------------------------------------------------------------


@query("SELECT pathway_i, round(p_a, 6) AS p_a, round(pmu_a, 6) AS pmu_a, round(brf, 6) AS brf, round(active_fraction, 6) AS active_fraction FROM params", "params")
def reduce_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return params_of(spark, sf_dir, keyed(spark, sf_dir)).select("pathway_i", *[r6(c).alias(c) for c in ("p_a", "pmu_a", "brf", "active_fraction")])


@query("SELECT src, dst, synapse_id FROM reduced", "reduced")
def reduce_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = keyed(spark, sf_dir)
    return sampling.reduce_step(df, params_of(spark, sf_dir, df), fx.SEED).select("src", "dst", "synapse_id")


def _survivors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    df = keyed(spark, sf_dir)
    params = params_of(spark, sf_dir, df)
    return sampling.cut_step(sampling.connection_counts(sampling.reduce_step(df, params, fx.SEED)), params, fx.SEED), params


@query("SELECT src, dst, n, round(survival, 6) AS survival FROM survivors", "survivors")
def cut_survival(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _survivors(spark, sf_dir)[0].select("src", "dst", "n", r6("survival").alias("survival"))


@query("SELECT pathway_i, round(actual, 6) AS actual, round(fraction, 6) AS fraction FROM fractions", "fractions")
def active_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.active_fractions(*_survivors(spark, sf_dir)).select("pathway_i", r6("actual").alias("actual"), r6("fraction").alias("fraction"))


@query("SELECT r.src, r.dst, r.synapse_id FROM reduced r JOIN kept USING (src, dst)", "reduced", "kept")
def reduce_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = keyed(spark, sf_dir)
    return sampling.reduce_and_cut(df, params_of(spark, sf_dir, df), fx.SEED).select("src", "dst", "synapse_id")


_BINS = {
    "b": "SELECT *, CASE WHEN spine_length >= 5 THEN 5 ELSE CAST(floor(spine_length) AS INT) END AS bin FROM edges",
    "h": "SELECT bin, count(*) AS have FROM b GROUP BY bin",
    "w": "SELECT * FROM (VALUES (0, 0.1::DOUBLE - 0.0), (1, 0.3::DOUBLE - 0.1::DOUBLE), (2, 0.7::DOUBLE - 0.3::DOUBLE), (3, 0.9::DOUBLE - 0.7::DOUBLE), (4, 1.0::DOUBLE - 0.9::DOUBLE)) t(bin, want)",
    "s": "SELECT bin, (want / have) / max(want / have) OVER () AS survival FROM h JOIN w USING (bin)",
}
_BINNED = ", ".join(f"{name} AS ({sql})" for name, sql in _BINS.items())


@query()
def spine_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.match_histogram(fx.edges(spark, sf_dir), "spine_length", fx.SPINE_EDGES, fx.SPINE_CUMULATIVE, fx.SEED).select("src", "dst", "synapse_id")


ORACLES["spine_length"] = fx.with_sql("edges").rstrip() + f", {_BINNED} SELECT src, dst, synapse_id FROM b JOIN s USING (bin) WHERE {fx.uniform_sql(fx.SEED, 0x200, 'synapse_id')} <= survival"


# -- properties -------------------------------------------------------------------------------


def _classified(spark: SparkSession, df: DataFrame) -> DataFrame:
    """(pathway_i, parameters) of each class pair, on the distinct pairs only."""
    pairs = df.select("pathway_i", "src_synapse_class_i", "dst_synapse_class_i").distinct()
    params = fx.property_params(spark)
    codes = ["src_synapse_class_i", "dst_synapse_class_i"]
    found = rules.classify_last_match(pairs, params.select("rule_i", *codes), codes)
    return found.join(params.drop(*codes), "rule_i").drop("rule_i", *codes)


def _by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.with_pathway(fx.circuit(spark, sf_dir), ["src_synapse_class", "dst_synapse_class"], [2, 2])


def _propertied(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _by_class(spark, sf_dir)
    return properties.connection_properties(df, _classified(spark, df), fx.SEED)


@query("SELECT DISTINCT src_synapse_class_i * 2 + dst_synapse_class_i AS pathway_i, CASE WHEN src_synapse_class_i = 1 THEN 'I2' ELSE 'E2' END AS class FROM circuit", "circuit")
def classify_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, _by_class(spark, sf_dir)).select("pathway_i", "class")


@query("SELECT synapse_id, round(CAST(CAST(CASE WHEN src_synapse_class_i = 1 AND dst_synapse_class_i = 1 THEN 0.4 ELSE 0.1 END + distance_soma / 0.00333 AS FLOAT) AS DOUBLE), 1) AS delay, CASE WHEN src_synapse_class_i = 1 THEN 0 ELSE 100 END AS syn_type_id, CASE WHEN src_synapse_class_i = 1 THEN 0 ELSE 1 END AS syn_property_rule FROM circuit", "circuit")
def synapse_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _by_class(spark, sf_dir)
    with_rules = df.join(_classified(spark, df), "pathway_i")
    return properties.derive_properties(with_rules).select("synapse_id", F.round(F.col("delay").cast("double"), 1).alias("delay"), F.col("syn_type_id").cast("int").alias("syn_type_id"), F.col("syn_property_rule").cast("int").alias("syn_property_rule"))


@query()
def connection_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [name for name, _, _ in properties.DRAWS]
    return _propertied(spark, sf_dir).select("src", "dst", "synapse_id", "class", *[r6(c).alias(c) if c != "n_rrp_vesicles" else F.col(c).cast("int").alias(c) for c in names])


def _draw_sql(name: str, key: int, kind: str) -> str:
    if kind == "poisson":  # of a mean of one at most, which all classes have
        return f"1 AS {name}"
    draw = fx.gamma_sql if kind == "gamma" else fx.trunc_normal_sql
    return f"round({draw(fx.SEED, key, 'first_id', f'{name}_mu', f'{name}_sd')}, 6) AS {name}"


ORACLES["connection_properties"] = fx.with_sql("circuit", "classes") + (
    "SELECT c.src, c.dst, c.synapse_id, d.* EXCLUDE (src, dst) FROM circuit c JOIN (SELECT src, dst, \"class\", "
    + ", ".join(_draw_sql(*d) for d in properties.DRAWS)
    + " FROM (SELECT src, dst, min(synapse_id) AS first_id, min(CASE WHEN src_synapse_class_i = 1 THEN 'I2' ELSE 'E2' END) AS kind FROM circuit GROUP BY src, dst) JOIN classes ON \"class\" = kind) d ON d.src = c.src AND d.dst = c.dst"
)


@query("SELECT src, dst, 1 AS n_sets, 0 AS n_negative, 0 AS n_mismatched FROM (SELECT DISTINCT src, dst FROM circuit)", "circuit")
def property_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One set of properties a connection, none negative, and the class that the source's class asks for."""
    names = [name for name, _, _ in properties.DRAWS]
    wanted = F.when(F.col("src_synapse_class_i") == 1, "I2").otherwise("E2")
    found = quality.property_invariants(_propertied(spark, sf_dir), ["class", *names], names, F.col("class") == wanted)
    return found.select("src", "dst", *[F.col(c).cast("int").alias(c) for c in ("n_sets", "n_negative", "n_mismatched")])


@query("SELECT synapse_id, CASE WHEN m THEN f.section_id ELSE c.afferent_section_id END AS afferent_section_id, CASE WHEN m THEN 1 ELSE c.afferent_section_type END AS afferent_section_type, CASE WHEN m THEN 0 ELSE c.afferent_segment_id END AS afferent_segment_id, round(CASE WHEN m THEN f.\"offset\" END, 6) AS afferent_segment_offset, round(CASE WHEN m THEN f.root_distance ELSE c.distance_soma END, 6) AS distance_soma FROM (SELECT k.*, (n.n_name GLOB 'NATION_1*' OR (n.n_name = 'NATION_7' AND d.value = 'SMALL')) AND g.section_id IS NOT NULL AS m FROM circuit k JOIN nation n ON n_nationkey = src_mtype_i JOIN dtypes d ON d.code = dst_mtype_i LEFT JOIN firstsec g ON g.morphology = k.src_morphology) c LEFT JOIN firstsec f ON f.morphology = c.src_morphology", "circuit", "firstsec")
def reposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fx.circuit(spark, sf_dir)
    targets = geometry.first_section(fx.sections(spark, sf_dir), fx.points(spark, sf_dir), properties.AXON)
    moved = properties.reposition(df, moved_pathways(spark, sf_dir, df), list(MTYPES.values()), targets)
    return moved.select("synapse_id", "afferent_section_id", "afferent_section_type", "afferent_segment_id", r6("afferent_segment_offset").alias("afferent_segment_offset"), r6("distance_soma").alias("distance_soma"))


_LIBRARY = ", ".join(f"({k + 1}, {x}::DOUBLE)" for k, x in enumerate(fx.SPINE_LENGTHS))


@query()
def nearest_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fx.circuit(spark, sf_dir).withColumn("syn_type_id", F.when(F.col("src_synapse_class_i") == 1, 0).otherwise(100))
    return matching.assign_spines(df, fx.spine_library(spark)).select("synapse_id", "spine_morphology", "spine_psd_id", "spine_sharing_id")


ORACLES["nearest_spine"] = fx.with_sql("circuit").rstrip() + f", lib AS (SELECT * FROM (VALUES {_LIBRARY}) t(i, len)), lens AS (SELECT DISTINCT spine_length FROM circuit), best AS (SELECT spine_length, arg_min(i, round(abs(spine_length - len), 9) * 1000 + i * 1e-7) AS i FROM lens, lib GROUP BY spine_length) SELECT synapse_id, CASE WHEN off THEN '' ELSE 'spine_' || (i - 1) END AS spine_morphology, CASE WHEN off THEN -1 ELSE 1 END AS spine_psd_id, -1 AS spine_sharing_id FROM (SELECT *, src_synapse_class_i = 1 OR src_morph_class = 'INT' AS off FROM circuit) JOIN best USING (spine_length)"


# -- geometry ---------------------------------------------------------------------------------


@query("SELECT morphology, section_id, idx, round(path_length, 6) AS path_length FROM paths", "paths")
def path_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.path_lengths(fx.points(spark, sf_dir)).select("morphology", "section_id", "idx", r6("path_length").alias("path_length"))


@query("SELECT morphology, section_id, idx, round(root_distance, 6) AS root_distance FROM rootdist", "rootdist")
def root_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.root_distances(fx.sections(spark, sf_dir), fx.points(spark, sf_dir)).withColumn("root_distance", r6("root_distance"))


@query("SELECT morphology, section_id, ancestor_id, depth FROM above", "above")
def section_ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.ancestors(fx.sections(spark, sf_dir))


@query("SELECT morphology, section_id, enter, leave FROM intervals", "intervals")
def section_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.section_intervals(fx.sections(spark, sf_dir))


@query("SELECT morphology, section_id, round(\"offset\", 6) AS \"offset\", round(fraction, 6) AS fraction, round(root_distance, 6) AS root_distance FROM firstsec", "firstsec")
def first_axon_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = geometry.first_section(fx.sections(spark, sf_dir), fx.points(spark, sf_dir), properties.AXON)
    return found.select("morphology", "section_id", *[r6(c).alias(c) for c in ("offset", "fraction", "root_distance")])


# -- reciprocal edges -------------------------------------------------------------------------


@query()
def reciprocal_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.reciprocal_exact(fx.reciprocal_edges(spark, sf_dir))


_RANKED = "r AS (SELECT *, row_number() OVER (PARTITION BY src, dst, efferent_section_id, efferent_segment_id, afferent_section_id, afferent_segment_id ORDER BY synapse_id) AS place FROM redges WHERE src <> dst)"
ORACLES["reciprocal_exact"] = fx.with_sql("redges").rstrip() + f", {_RANKED} SELECT a.src, a.dst, a.synapse_id, b.synapse_id AS partner_id FROM r a JOIN r b ON a.src = b.dst AND a.dst = b.src AND a.efferent_section_id = b.afferent_section_id AND a.afferent_section_id = b.efferent_section_id AND a.efferent_segment_id = b.afferent_segment_id AND a.afferent_segment_id = b.efferent_segment_id AND a.place = b.place"


@query("SELECT synapse_id, src, dst, out_segment AS efferent_segment_id, in_segment AS afferent_segment_id, synapse_id AS efferent_junction_id, partner AS afferent_junction_id FROM matched", "matched")
def reciprocal_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy matching with segments at most one apart."""
    found = matching.match_reciprocal(fx.reciprocal_edges(spark, sf_dir))
    return found.select("synapse_id", "src", "dst", "efferent_segment_id", "afferent_segment_id", "efferent_junction_id", "afferent_junction_id")


def _junctions(spark: SparkSession, sf_dir: str, df: DataFrame) -> DataFrame:
    """Matched and pruned edges; morphologies are named after nodes."""
    sections, points = fx.sections(spark, sf_dir), fx.points(spark, sf_dir)
    # the matched edges are read three times below
    matched, _ = written(matching.match_reciprocal(df).withColumn("src_morphology", F.concat(F.lit("M"), "src")))
    return matching.prune_near_root(matched, geometry.section_intervals(sections), geometry.root_distances(sections, points), geometry.root_radii(sections, points))


@query("SELECT src, dst, synapse_id, synapse_id AS efferent_junction_id, partner AS afferent_junction_id, CAST(0.75 AS DOUBLE) AS conductance FROM junctions", "junctions")
def gap_junction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pruned = _junctions(spark, sf_dir, fx.reciprocal_edges(spark, sf_dir))
    return properties.with_conductance(pruned, 0.75).select("src", "dst", "synapse_id", "efferent_junction_id", "afferent_junction_id", "conductance")


def gap_junction_steps(spark: SparkSession, sf_dir: str) -> dict[str, pipeline.Step]:
    """The steps of the preset for gap junctions: far enough from the body, matched and pruned, numbered anew, with a conductance."""

    def far(df: DataFrame) -> DataFrame:
        named = df.withColumn("dst_morphology", F.concat(F.lit("M"), "dst"))
        return properties.min_distance_by_key(named, geometry.root_radii(fx.sections(spark, sf_dir), fx.points(spark, sf_dir))).drop("dst_morphology")

    def number(df: DataFrame) -> DataFrame:
        return ids.dense_id(df.drop("synapse_id"), ["efferent_junction_id"])

    steps = (
        pipeline.Step("soma_distance", far, None, checkpoint=True),
        pipeline.Step("gap_junction", lambda df: _junctions(spark, sf_dir, df).drop("src_morphology"), None, added=frozenset({"efferent_junction_id", "afferent_junction_id"}), checkpoint=True),
        pipeline.Step("dense_id", number, None, reductive=False),
        pipeline.Step("gap_junction_properties", lambda df: properties.with_conductance(df, 0.75), 0.75, added=frozenset({"conductance"}), reductive=False, checkpoint=True),
    )
    return {s.name: s for s in steps}


@query()
def gap_junction_preset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The preset for gap junctions end to end, exported and read back."""
    out, steps = scratch(spark, "export"), pipeline.preset(pipeline.GAP_JUNCTIONS, gap_junction_steps(spark, sf_dir))
    found = pipeline.run(spark, lambda: fx.reciprocal_edges(spark, sf_dir), [sf_dir, uuid.uuid4().hex], steps, scratch(spark, "preset"))
    tables.export(found, out, tables.POST)
    return spark.read.parquet(out).select("source_node_id", "target_node_id", "synapse_id", "efferent_junction_id", "afferent_junction_id", "efferent_segment_id", "afferent_segment_id", "conductance")


_FAR_EDGES = {"redges0": (fx.SQL["redges"], []), "redges": ("SELECT e.* FROM redges0 e JOIN radii ON morphology = 'M' || dst WHERE distance_soma >= radius", ["redges0", "radii"])}
ORACLES["gap_junction_preset"] = fx.with_sql("junctions", instead=_FAR_EDGES) + "SELECT src AS source_node_id, dst AS target_node_id, row_number() OVER (ORDER BY src, dst, synapse_id) - 1 AS synapse_id, synapse_id AS efferent_junction_id, partner AS afferent_junction_id, out_segment AS efferent_segment_id, in_segment AS afferent_segment_id, CAST(0.75 AS DOUBLE) AS conductance FROM junctions"


# -- sinks, comparison, checkpoints -----------------------------------------------------------

_EXPORTED = "SELECT src AS source_node_id, dst AS target_node_id, synapse_id, distance_soma, afferent_section_type + 1 AS afferent_section_type, efferent_section_type + 1 AS efferent_section_type, 0 AS edge_type_id FROM edges"


def _exported(spark: SparkSession, sf_dir: str, order: tuple[str, ...]) -> DataFrame:
    path = scratch(spark, "export")
    df = fx.circuit(spark, sf_dir).select("src", "dst", "synapse_id", "distance_soma", "afferent_section_type", "efferent_section_type", "src_mtype_i")
    tables.export(df, path, order, {"source_population_name": "A", "source_population_size": "100"})
    return spark.read.parquet(path)


@query(_EXPORTED, "edges")
def export_post(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exported(spark, sf_dir, tables.POST)


@query(_EXPORTED, "edges")
def export_pre(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exported(spark, sf_dir, tables.PRE)


@query("SELECT src, dst, synapse_id, greatest(1, CAST(ceil(count(*) OVER () / 10000000) AS INT)) AS n_files FROM edges", "edges")
def compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges, with the number of files that 16 have become."""
    many, few = scratch(spark, "many"), scratch(spark, "few")
    fx.edges(spark, sf_dir).select("src", "dst", "synapse_id").repartition(16).write.parquet(many)
    found = tables.compact(spark, many, few)
    return found.withColumn("n_files", F.lit(len(found.inputFiles())))


@query("SELECT src, dst, count(*) AS n FROM edges GROUP BY src, dst", "edges")
def checkpoint_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = tables.fingerprint(["dense_id"], {}, [sf_dir, tables.folder_bytes(spark, f"{sf_dir}/lineitem.parquet")])
    path = f"{scratch(spark, 'state')}/{state}"
    tables.checkpointed(spark, lambda: fx.edges(spark, sf_dir), path)
    return tables.checkpointed(spark, lambda: fx.edges(spark, sf_dir).limit(0), path).groupBy("src", "dst").agg(F.count("*").alias("n"))


_MERGED = "SELECT src, dst, synapse_id, distance_soma, afferent_section_type, efferent_section_type FROM edges"


def _halves(spark: SparkSession, sf_dir: str) -> list[str]:
    """The edges as two exports, of even and of odd ids, with provenance."""
    df = fx.edges(spark, sf_dir).select("src", "dst", "synapse_id", "distance_soma", *tables.CODES)
    nodes = {"source_population_name": "A", "source_population_size": str(fx.source_nodes(spark, sf_dir).count())}
    paths = [scratch(spark, f"half{k}") for k in (0, 1)]
    for k, path in enumerate(paths):
        half = df.where(F.col("synapse_id") % 2 == k)
        tables.export(half, path, tables.POST, tables.provenance({"rows": str(half.count())}, pipeline.VERSION, [f"half{k}"], "", nodes))
    return paths


@query(_EXPORTED, "edges")
def merge_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge mode: two exports, whose codes start at one, are read, merged and exported again."""
    return pipeline.merge(spark, _halves(spark, sf_dir), scratch(spark, "merged"))


_PART = "(SELECT max(p_partkey) FROM part)"


@query(f"SELECT src, dst, synapse_id, '0,1' AS inputs FROM edges WHERE dst * 5 > {_PART} * 2 AND dst * 5 <= {_PART} * 3", "edges")
def merge_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges that two exports with overlapping ranges of target nodes have in common, for which merge mode refuses them."""
    df, last = fx.edges(spark, sf_dir).select("src", "dst", "synapse_id", "distance_soma", *tables.CODES), fx.table(spark, sf_dir, "part").agg(F.max("p_partkey")).first()[0]
    paths = [scratch(spark, f"range{k}") for k in (0, 1)]
    for path, half in zip(paths, (df.where(F.col("dst") * 5 <= last * 3), df.where(F.col("dst") * 5 > last * 2)), strict=True):
        tables.export(half, path)
    return tables.overlaps(spark, paths).withColumn("inputs", F.array_join("inputs", ","))


@query("SELECT 'afferent_section_type' AS name, min(afferent_section_type) + 1 AS low, max(afferent_section_type) + 1 AS high, 1 AS base FROM edges UNION ALL SELECT 'efferent_section_type', min(efferent_section_type) + 1, max(efferent_section_type) + 1, 1 FROM edges", "edges")
def footer_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of the section type codes of an export, from the footers of its files, and the base that follows."""
    path = scratch(spark, "codes")
    tables.export(fx.edges(spark, sf_dir).select("src", "dst", "synapse_id", *tables.CODES), path)
    ranges = tables.footer_ranges(spark, path, list(tables.CODES))
    return spark.createDataFrame([(c, *r, tables.base_of(ranges)) for c, r in ranges.items()], "name string, low long, high long, base int")


@query("SELECT key, value FROM (SELECT 'source_population_name' AS key, 'A' AS value UNION ALL SELECT 'source_population_size', CAST(count(*) AS VARCHAR) FROM supplier UNION ALL SELECT 'merge' || synapse_id % 2 || '_rows', CAST(count(*) AS VARCHAR) FROM edges GROUP BY synapse_id % 2 UNION ALL SELECT 'merge' || k || '_run1_operators', 'half' || k FROM range(2) r(k) UNION ALL SELECT 'run2_operators', 'edge_merge')", "edges")
def provenance_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the metadata of a merge says, read from the files: populations, rows and operators of both inputs, and the run that follows them."""
    out = scratch(spark, "merged")
    pipeline.merge(spark, _halves(spark, sf_dir), out)
    return spark.createDataFrame([x for x in tables.read_metadata(spark, out).items() if x[0].endswith(("_name", "_size", "_rows", "_operators"))], "key string, value string")


_OLD_NAMES = {"src": "connected_neurons_pre", "dst": "post_gid", "distance_soma": "distance_soma", "spine_length": "morpho_spine_length", "afferent_section_type": "post_branch_type", "efferent_section_type": "morpho_section_type_pre", "efferent_section_id": "pre_section", "efferent_segment_id": "morpho_segment_id_pre", "afferent_section_id": "post_section", "afferent_segment_id": "post_segment"}


@query(f"SELECT synapse_id, 0 AS edge_type_id, {', '.join(_OLD_NAMES)} FROM edges", "edges")
def legacy_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "old")
    fx.edges(spark, sf_dir).selectExpr("synapse_id", "0 AS synapse_type_id", *[f"{new} AS {old}" for new, old in _OLD_NAMES.items()]).write.parquet(path)
    return tables.read_edges(spark, [path]).select("synapse_id", "edge_type_id", *_OLD_NAMES)


@query("SELECT id, mtype_i, synapse_class_i, morphology, region_i FROM dstn WHERE region_i = 2", "dstn")
def node_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nodeset from the cache of a node file that is not read the second time."""
    path, folder = scratch(spark, "nodes"), scratch(spark, "cache")
    fx.target_nodes(spark, sf_dir).withColumn("y", F.lit(0.0)).write.parquet(path)
    tables.cached_nodes(spark, path, folder, "region_i = 2")
    return tables.cached_nodes(spark, path, folder, "region_i = 2")


# -- the functional preset, from candidate edges to properties --------------------------------


def functional_steps(spark: SparkSession, sf_dir: str) -> dict[str, pipeline.Step]:
    """The steps of the preset with the rules of the fixtures; what follows a bucketed state by (src, dst) needs no exchange on them."""

    def touches(df: DataFrame) -> DataFrame:
        return rules.allow_rules(df, touch_sets(spark, sf_dir), TOUCHING)

    def cut(df: DataFrame) -> DataFrame:
        df = model.with_pathway(df, *fx.PATHWAY)
        return sampling.reduce_and_cut(df, params_of(spark, sf_dir, df), fx.SEED).drop("pathway_i", "pathway_str")

    def move(df: DataFrame) -> DataFrame:
        targets = geometry.first_section(fx.sections(spark, sf_dir), fx.points(spark, sf_dir), properties.AXON)
        return properties.reposition(df, moved_pathways(spark, sf_dir, df), list(MTYPES.values()), targets)

    def draw(df: DataFrame) -> DataFrame:
        df = model.with_pathway(df, ["src_synapse_class", "dst_synapse_class"], [2, 2])
        return properties.derive_properties(properties.connection_properties(df, _classified(spark, df), fx.SEED)).drop("pathway_i", "pathway_str")

    drawn = frozenset({*(name for name, _, _ in properties.DRAWS), "delay", "syn_type_id", "syn_property_rule"})
    steps = (
        pipeline.Step("bouton_distance", lambda df: properties.class_threshold(df, "distance_soma", "dst_synapse_class_i", {1: 5.0, 0: 25.0}), [5.0, 25.0]),
        pipeline.Step("touch_rules", touches, fx.TOUCH_RULES, checkpoint=True),
        pipeline.Step("spine_length", lambda df: sampling.match_histogram(df, "spine_length", fx.SPINE_EDGES, fx.SPINE_CUMULATIVE, fx.SEED), [fx.SPINE_EDGES, fx.SPINE_CUMULATIVE, fx.SEED]),
        pipeline.Step("reduce_and_cut", cut, [fx.CONNECTION_RULES, fx.SEED], checkpoint=True, bucket_by=("src", "dst"), buckets=8),
        pipeline.Step("reposition", move, fx.REPOSITION_RULES, added=frozenset({"afferent_segment_offset"}), reductive=False),
        pipeline.Step("synapse_properties", draw, [fx.PROPERTY_RULES, fx.CLASSES, fx.SEED], dropped=frozenset({"distance_soma"}), added=drawn, checkpoint=True, reductive=False),
    )
    return {s.name: s for s in steps}


@query()
def functional_preset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The preset end to end, then resumed from its last state, which reads no edges."""
    folder, inputs = scratch(spark, "preset"), [sf_dir, uuid.uuid4().hex]
    steps = pipeline.preset(pipeline.FUNCTIONAL, functional_steps(spark, sf_dir))
    pipeline.run(spark, lambda: fx.circuit(spark, sf_dir), inputs, steps, folder)

    def unread() -> DataFrame:
        raise ValueError("a resumed run must not read the edges")

    found = pipeline.run(spark, unread, inputs, steps, folder)
    return found.select("src", "dst", "synapse_id", "afferent_section_id", r6("afferent_segment_offset").alias("afferent_segment_offset"), F.col("syn_type_id").cast("int").alias("syn_type_id"), F.round(F.col("delay").cast("double"), 1).alias("delay"))


_FILTERED = {
    "circuit0": (fx.SQL["circuit"], ["edges", "srcn", "dstn"]),
    "touching": ("SELECT * FROM circuit0 JOIN tcells USING (src_mtype_i, dst_mtype_i, afferent_section_type) WHERE (distance_soma >= 5 AND dst_synapse_class_i = 1) OR (distance_soma >= 25 AND dst_synapse_class_i = 0)", ["circuit0", "tcells"]),
    **{n: (q.replace("FROM edges", "FROM touching"), needs) for n, q, needs in (("b", _BINS["b"], ["touching"]), ("h", _BINS["h"], ["b"]), ("w", _BINS["w"], []), ("s", _BINS["s"], ["h", "w"]))},
    "circuit": (f"SELECT * EXCLUDE (bin, survival) FROM b JOIN s USING (bin) WHERE {fx.uniform_sql(fx.SEED, 0x200, 'synapse_id')} <= survival", ["b", "s"]),
    "cut": ("SELECT r.* FROM reduced r JOIN kept USING (src, dst)", ["reduced", "kept"]),
}
_MOVES = "(n.n_name GLOB 'NATION_1*' OR (n.n_name = 'NATION_7' AND d.value = 'SMALL')) AND f.section_id IS NOT NULL"
ORACLES["functional_preset"] = fx.with_sql("cut", "firstsec", instead=_FILTERED) + (
    "SELECT src, dst, synapse_id, CASE WHEN m THEN section_id ELSE afferent_section_id END AS afferent_section_id, round(CASE WHEN m THEN \"offset\" END, 6) AS afferent_segment_offset, CASE WHEN src_synapse_class_i = 1 THEN 0 ELSE 100 END AS syn_type_id, "
    "round(CAST(CAST(CASE WHEN src_synapse_class_i = 1 AND dst_synapse_class_i = 1 THEN 0.4 ELSE 0.1 END + CASE WHEN m THEN root_distance ELSE distance_soma END / 0.00333 AS FLOAT) AS DOUBLE), 1) AS delay "
    f"FROM (SELECT c.*, f.section_id, f.\"offset\", f.root_distance, {_MOVES} AS m FROM cut c JOIN nation n ON n_nationkey = src_mtype_i JOIN dtypes d ON d.code = dst_mtype_i LEFT JOIN firstsec f ON f.morphology = c.src_morphology)"
)


_CHANGED = "SELECT {0} AS run, '{1}' AS steps, count(*) AS n FROM edges WHERE {2} <= 0.6 AND distance_soma >= {3} AND spine_length >= {4}"


@query(" UNION ALL ".join(_CHANGED.format(k, names, fx.uniform_sql(fx.SEED, 0x202, "synapse_id"), x, y) for k, names, x, y in ((1, "sample,far,long", 40, 1), (2, "far,long", 50, 1), (3, "", 50, 1), (4, "long", 40, 2))), "edges")
def resumed_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which steps run, and what is left, when a rule in the middle changes, when nothing does, and when the last one does after a return to the first rules."""
    folder, inputs, ran, out = scratch(spark, "resume"), [sf_dir, uuid.uuid4().hex], [], []

    def step(name: str, apply, parameters: object) -> pipeline.Step:
        def seen(df: DataFrame) -> DataFrame:
            ran.append(name)
            return apply(df)

        return pipeline.Step(name, seen, parameters, checkpoint=True)

    for k, (distance, length) in enumerate(((40, 1), (50, 1), (50, 1), (40, 2)), 1):
        steps = [
            step("sample", lambda df: sampling.keyed_sample(df, 0.6, fx.SEED), [0.6, fx.SEED]),
            step("far", lambda df, x=distance: df.where(F.col("distance_soma") >= x), distance),
            step("long", lambda df, x=length: df.where(F.col("spine_length") >= x), length),
        ]
        ran.clear()
        found = pipeline.run(spark, lambda: fx.edges(spark, sf_dir), inputs, steps, folder)
        out.append(found.agg(F.lit(k).alias("run"), F.lit(",".join(ran)).alias("steps"), F.count("*").alias("n")))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


_RULES_TEXT = str(fx.CONNECTION_RULES).replace("'", "''")
_PARTED = "FROM (SELECT synapse_id % 2 AS part, n, min(n) OVER () = max(n) OVER () AS same FROM (SELECT synapse_id % 2 AS synapse_id, count(*) AS n FROM edges GROUP BY 1)) WHERE NOT same OR part = 0"


@query(f"SELECT key, value FROM (SELECT 'source_population_name' AS key, 'A' AS value UNION ALL SELECT 'source_population_size', CAST(count(*) AS VARCHAR) FROM srcn UNION ALL SELECT 'target_population_name', 'B' UNION ALL SELECT 'target_population_size', CAST(count(*) AS VARCHAR) FROM dstn UNION ALL SELECT CASE WHEN same THEN 'rows' ELSE 'merge' || part || '_rows' END, CAST(n AS VARCHAR) {_PARTED} UNION ALL SELECT CASE WHEN same THEN 'run1_version' ELSE 'merge' || part || '_run1_version' END, '1' {_PARTED} UNION ALL SELECT 'run2_version', '1' UNION ALL SELECT 'run2_operators', 'edge_merge' UNION ALL SELECT 'run2_rules_sha256', sha256('{_RULES_TEXT}'))", "edges", "srcn", "dstn")
def provenance_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of two inputs, of which the sizes come from the tables, merged and written with this run."""
    sizes = fx.edges(spark, sf_dir).groupBy((F.col("synapse_id") % 2).alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    population = {"source_population_name": "A", "source_population_size": str(fx.source_nodes(spark, sf_dir).count()), "target_population_name": "B", "target_population_size": str(fx.target_nodes(spark, sf_dir).count())}
    merged = tables.merge_metadata([{**population, "rows": str(r["n"]), "run1_version": "1"} for r in sizes])
    return tables.provenance_table(spark, tables.provenance(merged, "1", ["edge_merge"], str(fx.CONNECTION_RULES), population))


@query()
def pathway_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = keyed(spark, sf_dir).select("src_mtype_i", "dst_mtype_i", "synapse_id", "distance_soma")
    found = quality.pathway_diff(base, base.where("distance_soma >= 40 OR src_mtype_i = 3"), ["src_mtype_i", "dst_mtype_i"], 5, 0.1)
    return found.withColumn("diff_rel", r6("diff_rel"))


ORACLES["pathway_diff"] = fx.with_sql("keyed").rstrip() + ", a AS (SELECT src_mtype_i, dst_mtype_i, count(*) AS base FROM keyed GROUP BY ALL), b AS (SELECT src_mtype_i, dst_mtype_i, count(*) AS comp FROM keyed WHERE distance_soma >= 40 OR src_mtype_i = 3 GROUP BY ALL), j AS (SELECT src_mtype_i, dst_mtype_i, coalesce(base, 0) AS base, coalesce(comp, 0) AS comp FROM a FULL JOIN b USING (src_mtype_i, dst_mtype_i)) SELECT src_mtype_i, dst_mtype_i, base, comp, abs(base - comp) AS diff_abs, round(abs(base - comp) / greatest(base, comp), 6) AS diff_rel, CASE WHEN base = 0 THEN 'added' WHEN comp = 0 THEN 'lost' ELSE 'changed' END AS label FROM j WHERE abs(base - comp) > 5 AND abs(base - comp) / greatest(base, comp) > 0.1"


@query("SELECT count(*) AS expected, count(*) AS found, true AS same FROM redges JOIN dstn s ON s.id = src JOIN dstn t ON t.id = dst WHERE s.region_i = 2 AND t.region_i = 2", "redges", "dstn")
def nodeset_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = tables.apply_nodeset(fx.target_nodes(spark, sf_dir), "region_i = 2")
    full = fx.reciprocal_edges(spark, sf_dir)
    return quality.nodeset_check(full, model.assemble(full, nodes, nodes), nodes)


@query("SELECT 'all' AS stage, pathway_str, count(*) AS n FROM keyed GROUP BY ALL UNION ALL SELECT 'reduced', pathway_str, count(*) FROM reduced GROUP BY ALL", "keyed", "reduced")
def cut_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = keyed(spark, sf_dir)
    return quality.cut_counts({"all": df, "reduced": sampling.reduce_step(df, params_of(spark, sf_dir, df), fx.SEED)})


@query()
def eventlog_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event log whose stages are the orders of lineitem, written and read as JSON lines."""
    path = scratch(spark, "log")
    value = lambda name, x: F.struct(F.lit(name).alias("Name"), x.cast("long").cast("string").alias("Value"))
    info = F.struct(F.col("l_orderkey").alias("Stage ID"), F.col("n").alias("Completion Time"), F.array(value("internal.metrics.shuffle.read.remoteBytesRead", F.col("price")), value("internal.metrics.shuffle.write.bytesWritten", F.col("price") / 2), value("number of output rows", F.col("n"))).alias("Accumulables"))
    orders = fx.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum("l_extendedprice").alias("price"))
    orders.select(F.lit("SparkListenerStageCompleted").alias("Event"), info.alias("Stage Info")).write.json(path)
    return quality.eventlog_metrics(spark, path).drop("app")
