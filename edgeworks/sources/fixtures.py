"""Edges, nodes, rules and morphologies derived from the star-schema tables, with the same in SQL.

Everything but the small rule tables grows with the tables: edges come from lineitem, nodes from
supplier and part, morphologies from part (one for each node id). A part is a target of three of the sources, so a
connection has about ten edges at every size. The nodes of reciprocal edges are folded so that a pair of them has about 24 edges each way.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeworks.functions import random
from edgeworks.operators.ids import dense_id
from edgeworks.operators.model import assemble

from .checkpoint import temporary
from .package import ship
from .tables import changed_at, checkpointed, folder_bytes

SEED = 20261
SRC_MTYPES, DST_MTYPES = 25, 6
PATHWAY = (["src_mtype", "dst_mtype"], [SRC_MTYPES, DST_MTYPES])
SECTION_KINDS = ("soma", "axon", "basal", "apical")
SECTIONS, POINTS = 7, 6
#: Morphologies that a task makes the sections and points of.
MORPHOLOGIES = 20_000

_EDGE_EXPR = {
    "distance_soma": "l_extendedprice / 1000",
    "spine_length": "l_quantity / 10",
    "afferent_section_type": "l_linenumber % 4",
    "efferent_section_type": "(l_linenumber + 1) % 4",
    "efferent_section_id": "l_partkey % 7",
    "efferent_segment_id": "l_orderkey % 5",
    "afferent_section_id": "l_orderkey % 7",
    "afferent_segment_id": "l_partkey % 5",
}
#: One of three sources of a part, of n in all; and edges of a pair of folded nodes.
_SRC = "(l_partkey + l_suppkey % 3) % {n}"
PAIR_EDGES = 24
ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_stored: dict[tuple, str] = {}


def stored(spark: SparkSession, name: str, sf_dir: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What make() gives, written once an application, so that a query's time is that of its operator."""
    # a table that has changed under the same path makes a new one
    key = spark.sparkContext.applicationId, name, sf_dir, *(x(spark, f"{sf_dir}/lineitem.parquet") for x in (folder_bytes, changed_at))
    if key not in _stored:
        _stored[key] = temporary(spark, f"fixture-{name}")
    return checkpointed(spark, make, _stored[key])


def _raw(spark: SparkSession, sf_dir: str, src: str, dst: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.expr(src).alias("src"), F.expr(dst).alias("dst"), *ORDER, "l_quantity")


def _numbered(raw: DataFrame) -> DataFrame:
    """raw with dense ids and the other columns of edges. These follow from columns that the numbering deals and sorts anyway, so they are made after it."""
    return dense_id(raw, ORDER).select("src", "dst", *[F.expr(e).alias(c) for c, e in _EDGE_EXPR.items()], "synapse_id")


def raw_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges without ids, with the columns that order them."""
    return _raw(spark, sf_dir, _SRC.format(n=table(spark, sf_dir, "supplier").count()), "l_partkey")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, "edges", sf_dir, lambda: _numbered(raw_edges(spark, sf_dir)))


def reciprocal_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = math.floor(math.sqrt(table(spark, sf_dir, "lineitem").count() / PAIR_EDGES))
    return stored(spark, "reciprocal", sf_dir, lambda: _numbered(_raw(spark, sf_dir, f"l_suppkey % {n}", f"l_partkey % {n}")))


def source_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "s_nationkey AS mtype_i", "CAST(s_suppkey % 2 AS INT) AS synapse_class_i", "IF(s_suppkey % 3 = 0, 'PYR', 'INT') AS morph_class", "concat('M', s_suppkey) AS morphology")


def target_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(code, value) of the target nodes' types: a handful of names."""
    return table(spark, sf_dir, "part").select(F.col("p_type").alias("value")).distinct().selectExpr("CAST(row_number() OVER (ORDER BY value) - 1 AS INT) AS code", "value")


def target_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return parts.join(target_types(spark, sf_dir), F.col("p_type") == F.col("value")).selectExpr("p_partkey AS id", "code AS mtype_i", "CAST(p_partkey % 2 AS INT) AS synapse_class_i", "CAST(p_size % 5 AS INT) AS region_i", "concat('M', p_partkey) AS morphology")


def source_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr("n_nationkey AS code", "n_name AS value")


def section_kinds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(SECTION_KINDS)), "code int, value string")


def circuit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble(edges(spark, sf_dir), source_nodes(spark, sf_dir), target_nodes(spark, sf_dir))


def _morphologies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts, dealt by morphology in tasks of about MORPHOLOGIES: their one small file would be exploded by a task or two."""
    parts = table(spark, sf_dir, "part").selectExpr("concat('M', p_partkey) AS morphology", "p_partkey", "p_size")
    return parts.repartition(parts.count() // MORPHOLOGIES + 1, "morphology")


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A binary tree of sections for each part; section 0 is the root."""
    return _morphologies(spark, sf_dir).selectExpr("morphology", f"explode(sequence(0, {SECTIONS - 1})) AS section_id", "p_size").selectExpr("morphology", "section_id", "IF(section_id = 0, NULL, section_id div 2) AS parent_id", "IF(section_id = 0, 0, 1 + (section_id + p_size) % 3) AS type").withColumn("parent_id", F.col("parent_id").cast("int"))


_XYZ = ("(p_size % 7 + 1) * idx * 0.5 + section_id", "section_id * 2.0 + (idx * idx) % 5", "((p_partkey + idx) % 4) * 0.25")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _morphologies(spark, sf_dir).selectExpr("*", f"explode(sequence(0, {SECTIONS - 1})) AS section_id").selectExpr("*", f"explode(sequence(0, {POINTS - 1})) AS idx")
    return base.selectExpr("morphology", "section_id", "idx", *[f"CAST({e} AS DOUBLE) AS {c}" for c, e in zip("xyz", _XYZ, strict=True)])


TOUCH_RULES = ((0, "NATION_1*", "*", "soma"), (1, "NATION_2", "SMALL", "*"), (2, "*", "M*", "basal"), (3, "NATION_*3", "*", "a*"))
CONNECTION_FIELDS = ("brf", "cv", "mean", "sd", "af", "prob", "p_a", "pmu_a")
CONNECTION_RULES = (
    (0, "*", "ECONOMY", 0.3, 0.5, 4.0, None, None, None, None, None),
    (1, "*", "LARGE", 0.5, None, None, None, None, None, 0.8, 3.0),
    (2, "*", "MEDIUM", None, None, 5.0, 2.0, 0.6, None, None, None),
    (3, "*", "PROMO", 0.4, 0.6, None, None, None, 0.5, None, None),
    (4, "NATION_1*", "SMALL", 1.0, None, None, None, None, None, 1.0, 0.0),
    (5, "NATION_3", "ECONOMY", 0.9, None, None, None, None, None, 1.0, 1.0),
    (6, "NATION_2*", "LARGE", 0.1, 0.4, None, None, 0.5, None, None, None),
    (7, "NATION_4", "*", 0.6, 0.3, None, None, 0.7, None, None, None),
)
REPOSITION_RULES = ((0, "NATION_1*", "*"), (1, "NATION_7", "SMALL"))
# fixed values: property rules by class code (-1: any), and the distributions of the classes
PROPERTY_RULES = ((0, -1, -1, "E2", None, 0.00333), (1, 1, 1, "I2", 0.4, 0.00333), (2, 0, 1, "E2", None, 0.00333), (3, 1, 0, "I2", None, 0.00333))
CLASSES = (
    {"class": "I2", "class_i": 0, "conductance_mu": 0.33, "conductance_sd": 0.28, "decay_time_mu": 8.3, "decay_time_sd": 2.2, "u_syn_mu": 0.25, "u_syn_sd": 0.13, "depression_time_mu": 706.0, "depression_time_sd": 405.0, "facilitation_time_mu": 21.0, "facilitation_time_sd": 9.0, "n_rrp_vesicles_mu": 0.0},
    {"class": "E2", "class_i": 1, "conductance_mu": 0.3, "conductance_sd": 0.2, "decay_time_mu": 1.74, "decay_time_sd": 0.18, "u_syn_mu": 0.0, "u_syn_sd": 0.5, "depression_time_mu": 671.0, "depression_time_sd": 17.0, "facilitation_time_mu": 17.0, "facilitation_time_sd": 5.0, "n_rrp_vesicles_mu": 1.0},
)
SPINE_EDGES, SPINE_CUMULATIVE = [0.0, 1.0, 2.0, 3.0, 4.0, 5.0], [0.0, 0.1, 0.3, 0.7, 0.9, 1.0]
#: Lengths of the spine library, from 2.305 to 4.059 in equal steps.
SPINE_LENGTHS = [round(2.305 + k * 0.1349, 4) for k in range(14)]


def spine_library(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k + 1, x, f"spine_{k}", 1) for k, x in enumerate(SPINE_LENGTHS)], "spine_index int, spine_length double, spine_morphology string, spine_psd_id int")


def property_params(spark: SparkSession) -> DataFrame:
    rules = spark.createDataFrame(list(PROPERTY_RULES), "rule_i int, src_synapse_class_i int, dst_synapse_class_i int, class string, neural_transmitter_release_delay double, axonal_conduction_velocity double")
    return rules.join(spark.createDataFrame([tuple(c.values()) for c in CLASSES], ", ".join(f"`{k}` {'string' if k == 'class' else 'int' if k == 'class_i' else 'double'}" for k in CLASSES[0])), "class")


# -- the same in SQL --------------------------------------------------------------------------


def _sql_edges(src: str, dst: str) -> str:
    columns = ", ".join(f"{e} AS {c}" for c, e in _EDGE_EXPR.items())
    return f"SELECT row_number() OVER (ORDER BY {src}, {dst}, {', '.join(ORDER)}) - 1 AS synapse_id, {src} AS src, {dst} AS dst, {columns} FROM lineitem"


_FOLDED = f"(SELECT CAST(floor(sqrt(count(*) / {PAIR_EDGES})) AS BIGINT) FROM lineitem)"


def _values(rows: tuple, names: str) -> str:
    def one(x: object) -> str:
        return "NULL" if x is None else f"'{x}'" if isinstance(x, str) else f"CAST({x!r} AS DOUBLE)" if isinstance(x, float) else repr(x)

    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(one, r)) + ')' for r in rows)}) t({names})"


_MU = "1 - 0.5 / cv + (1 / cv - 1) * {0}"
_RED = "q / (1 - q) * ({1} * (1 - 1 / {0}) ** {1} + (1 - 1 / {0}) ** ({1} + 1) * {0})"
SQL = {
    "edges": _sql_edges(_SRC.format(n="(SELECT count(*) FROM supplier)"), "l_partkey"),
    "redges": _sql_edges(f"l_suppkey % {_FOLDED}", f"l_partkey % {_FOLDED}"),
    "srcn": "SELECT s_suppkey AS id, s_nationkey AS mtype_i, s_suppkey % 2 AS synapse_class_i, CASE WHEN s_suppkey % 3 = 0 THEN 'PYR' ELSE 'INT' END AS morph_class, 'M' || s_suppkey AS morphology FROM supplier",
    "dtypes": f"SELECT row_number() OVER (ORDER BY p_type) - 1 AS code, p_type AS value FROM (SELECT DISTINCT p_type FROM part)",
    "dstn": f"SELECT p_partkey AS id, code AS mtype_i, p_partkey % 2 AS synapse_class_i, p_size % 5 AS region_i, 'M' || p_partkey AS morphology FROM part JOIN dtypes ON p_type = value",
    "circuit": "SELECT e.*, s.mtype_i AS src_mtype_i, s.synapse_class_i AS src_synapse_class_i, s.morph_class AS src_morph_class, s.morphology AS src_morphology, d.mtype_i AS dst_mtype_i, d.synapse_class_i AS dst_synapse_class_i, d.region_i AS dst_region_i, d.morphology AS dst_morphology FROM edges e JOIN srcn s ON e.src = s.id JOIN dstn d ON e.dst = d.id",
    "keyed": f"SELECT *, src_mtype_i * {DST_MTYPES} + dst_mtype_i AS pathway_i, 'src_mtype=' || src_mtype_i || ', dst_mtype=' || dst_mtype_i AS pathway_str FROM circuit",
    "stats": "SELECT pathway_i, CAST(sum(n) AS BIGINT) AS total_touches, count(*) AS total_connections, sum(n) / count(*) AS structural_mean FROM (SELECT pathway_i, src, dst, count(*) AS n FROM keyed GROUP BY ALL) GROUP BY pathway_i",
    "sections": f"SELECT 'M' || p_partkey AS morphology, section_id, CASE WHEN section_id = 0 THEN NULL ELSE section_id // 2 END AS parent_id, CASE WHEN section_id = 0 THEN 0 ELSE 1 + (section_id + p_size) % 3 END AS type FROM part, range({SECTIONS}) s(section_id)",
    "points": "SELECT 'M' || p_partkey AS morphology, section_id, idx, " + ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in zip("xyz", _XYZ, strict=True)) + f" FROM part, range({SECTIONS}) s(section_id), range({POINTS}) i(idx)",
    "paths": "SELECT *, sum(step) OVER (PARTITION BY morphology, section_id ORDER BY idx) AS path_length FROM (SELECT *, coalesce(sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2 + (z - lag(z) OVER w) ** 2), 0) AS step FROM points WINDOW w AS (PARTITION BY morphology, section_id ORDER BY idx))",
    "lengths": "SELECT morphology, section_id, max(path_length) AS length FROM paths GROUP BY ALL",
    "above": "SELECT morphology, section_id, section_id AS ancestor_id, 0 AS depth FROM sections UNION ALL SELECT a.morphology, a.section_id, s.parent_id, a.depth + 1 FROM above a JOIN sections s ON s.morphology = a.morphology AND s.section_id = a.ancestor_id WHERE s.parent_id IS NOT NULL",
    "rootdist": "SELECT p.morphology, p.section_id, p.idx, p.path_length + coalesce(b.before, 0) AS root_distance FROM paths p LEFT JOIN (SELECT a.morphology, a.section_id, sum(CASE WHEN a.ancestor_id = 0 THEN 0 ELSE l.length END) AS before FROM above a JOIN lengths l ON l.morphology = a.morphology AND l.section_id = a.ancestor_id WHERE depth > 0 GROUP BY ALL) b ON b.morphology = p.morphology AND b.section_id = p.section_id",
    "radii": "SELECT p.morphology, max(sqrt((x - cx) ** 2 + (y - cy) ** 2 + (z - cz) ** 2)) AS radius FROM points p JOIN (SELECT morphology, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz FROM points WHERE section_id = 0 GROUP BY ALL) c ON c.morphology = p.morphology WHERE section_id = 0 GROUP BY ALL",
    "firstsec": "SELECT f.morphology, f.section_id, least(0.5, g.segment) AS \"offset\", least(0.5, g.segment) / g.length AS fraction, r.root_distance + least(0.5, g.segment) AS root_distance FROM (SELECT morphology, min(section_id) AS section_id FROM sections WHERE type = 1 GROUP BY ALL) f JOIN (SELECT morphology, section_id, max(CASE WHEN idx = 1 THEN path_length END) AS segment, max(path_length) AS length FROM paths GROUP BY ALL) g USING (morphology, section_id) JOIN rootdist r ON r.morphology = f.morphology AND r.section_id = f.section_id AND r.idx = 0",
    "kinds": _values(tuple(enumerate(SECTION_KINDS)), "code, value"),
    "trules": _values(TOUCH_RULES, "rule_i, src_mtype, dst_mtype, kind"),
    "tcells": "SELECT DISTINCT n.n_nationkey AS src_mtype_i, d.code AS dst_mtype_i, k.code AS afferent_section_type FROM trules r JOIN nation n ON n.n_name GLOB r.src_mtype JOIN dtypes d ON d.value GLOB r.dst_mtype JOIN kinds k ON k.value GLOB r.kind",
    "classes": _values(tuple(tuple(c.values()) for c in CLASSES), ", ".join(f'"{k}"' for k in CLASSES[0])),
    "crules": _values(CONNECTION_RULES, "rule_i, src_mtype, dst_mtype, " + ", ".join(CONNECTION_FIELDS)),
    "rulep": f"SELECT n_nationkey * {DST_MTYPES} + code AS pathway_i, " + ", ".join(f"arg_max(struct_pack(v := {c}), rule_i).v AS {c}" for c in CONNECTION_FIELDS) + " FROM crules r JOIN nation n ON n_name GLOB src_mtype JOIN dtypes d ON value GLOB dst_mtype GROUP BY 1",
    "params0": "SELECT s.*, 1.0 / structural_mean AS p, r.brf, r.cv, r.mean, r.sd, r.af, r.prob, r.p_a AS rpa, r.pmu_a AS rpmu, r.pathway_i IS NULL AS none FROM stats s LEFT JOIN rulep r ON r.pathway_i = s.pathway_i",
    "params1": "SELECT *, CASE WHEN cv IS NOT NULL AND brf IS NOT NULL THEN least(mean * cv, structural_mean - 0.5) ELSE sd END AS spread, CASE WHEN none THEN 'none' WHEN brf IS NOT NULL AND cv IS NOT NULL AND af IS NOT NULL THEN '4.3' WHEN brf IS NOT NULL AND cv IS NOT NULL AND mean IS NOT NULL THEN '4.2' WHEN brf IS NOT NULL AND cv IS NOT NULL AND prob IS NOT NULL THEN 'prob' WHEN brf IS NOT NULL AND rpa IS NOT NULL AND rpmu IS NOT NULL THEN 'default' WHEN mean IS NOT NULL AND sd IS NOT NULL THEN '4.1' ELSE 'other' END AS kase FROM params0",
    "params2": "SELECT *, CASE kase WHEN '4.2' THEN 1 / (sqrt(spread ** 2 + 0.25) + 0.5) WHEN '4.1' THEN 1 / (spread + 0.5) END AS pp, brf / prob AS mod FROM params1",
    "solve0": "SELECT pathway_i, brf / af AS target, cv, CASE WHEN p >= 1 THEN p + 1e-5 ELSE p END AS q, greatest(1 / CASE WHEN p >= 1 THEN p + 1e-5 ELSE p END, 1 + 1e-9) AS top FROM params1 WHERE kase = '4.3'",
    "solve1": f"SELECT *, {_MU.format('top')} AS mu_top, {_RED.format('top', '(' + _MU.format('top') + ')')} >= target AS inside FROM solve0",
    "solve2": f"SELECT *, CASE WHEN inside THEN 1 + 1e-9 ELSE 1.0 END::DOUBLE AS low, CASE WHEN inside THEN top ELSE greatest(1.0, mu_top) END::DOUBLE AS high, 0 AS step FROM solve1 UNION ALL SELECT * EXCLUDE (low, high, step, mid, up), CASE WHEN up THEN mid ELSE low END, CASE WHEN up THEN high ELSE mid END, step + 1 FROM (SELECT *, CASE WHEN inside THEN {_RED.format('mid', '(' + _MU.format('mid') + ')')} < target ELSE {_RED.format('top', 'mid')} > target END AS up FROM (SELECT *, (low + high) / 2 AS mid FROM solve2 WHERE step < 60))",
    "solved": f"SELECT pathway_i, q / (1 - q) * (mean_solved - 1) AS p_solved, CASE WHEN inside THEN {_MU.format('mean_solved')} ELSE (low + high) / 2 END AS mu_solved FROM (SELECT *, CASE WHEN inside THEN (low + high) / 2 ELSE top END AS mean_solved FROM solve2 WHERE step = 60)",
    "params": "SELECT params2.pathway_i, total_touches, total_connections, structural_mean, least(1.0, CASE kase WHEN 'none' THEN 1.0 WHEN 'default' THEN rpa WHEN 'prob' THEN mod * cv WHEN 'other' THEN 1.0 WHEN '4.3' THEN p_solved ELSE CASE WHEN p = 1 THEN 1.0 ELSE p / (1 - p) * (1 - pp) / pp END END) AS p_a, CASE kase WHEN '4.3' THEN mu_solved - 0.5 WHEN 'default' THEN rpmu WHEN 'prob' THEN greatest((structural_mean - cv * structural_mean + cv) * mod, 1) - 0.5 WHEN '4.2' THEN mean - spread WHEN '4.1' THEN mean - spread END AS pmu_a, CASE kase WHEN '4.1' THEN 0.04 WHEN 'none' THEN NULL ELSE brf END AS brf, CASE kase WHEN '4.3' THEN least(1.0, af) WHEN '4.2' THEN 0.5 WHEN 'default' THEN 0.5 WHEN '4.1' THEN least(1.0, af) WHEN 'prob' THEN least(1.0, exp((1 - cv) / cv) * brf * (structural_mean - 1) / (structural_mean * mod)) END AS active_fraction FROM params2 LEFT JOIN solved ON solved.pathway_i = params2.pathway_i",
}


def uniform_sql(seed: int, key: int, row_id: str) -> str:
    return f"(('0x' || substr(md5('{seed}:{key}:' || {row_id}), 1, 13))::BIGINT / 4503599627370496.0)"


def _let_sql(value: str, name: str, body: str) -> str:
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def counter_sql(seed: int, key: int, row_id: str) -> str:
    """The number of keyed_counter(), its rounds one in the other."""
    mask, a, b = 2**32 - 1, seed % 2**32, key % 2**32
    keys = (a, b, a ^ b ^ random.PARITY)
    state = f"{{'x': (({row_id} & {mask}) + {a}) & {mask}, 'y': ((({row_id} >> 32) & {mask}) + {b}) & {mask}}}"
    for n in range(random.ROUNDS):
        r, k = random.ROTATIONS[n % 8], (n + 1) // 4
        more = (keys[k % 3], keys[(k + 1) % 3] + k) if n % 4 == 3 else (0, 0)
        turned = f"xor(((s.y << {r}) | (s.y >> {32 - r})) & {mask}, (s.x + s.y) & {mask})"
        state = _let_sql(state, "s", f"{{'x': (s.x + s.y + {more[0]}) & {mask}, 'y': ({turned} + {more[1]}) & {mask}}}")
    return _let_sql(state, "w", "(((w.x >> 6) << 26) + (w.y >> 6)) / 4503599627370496.0")


def gamma_sql(seed: int, key: int, row_id: str, mean: str, sd: str) -> str:
    """The draw of keyed_gamma()."""
    shape = f"(({mean}) ** 2 / ({sd}) ** 2)"
    least = f"(CASE WHEN {shape} < 1 THEN {shape} + 1 ELSE {shape} END - 1.0::DOUBLE / 3)"
    u = lambda k: uniform_sql(seed, key, f"{row_id} || ':' || ({k})")
    taken = f"CASE WHEN v > 0 AND ln(1 - {u('3 * k + 2')}) < 0.5 * z * z + {least} * (1 - v + ln(greatest(v, 1e-300))) THEN {least} * v END"
    attempt = _let_sql(f"sqrt(-2 * ln(1 - {u('3 * k')})) * cos(2 * pi() * {u('3 * k + 1')})", "z", _let_sql(f"(1 + z / sqrt(9 * {least})) ** 3", "v", taken))
    return f"(list_filter(list_transform(range({random.TRIES}), lambda k: {attempt}), lambda x: x IS NOT NULL)[1] * CASE WHEN {shape} < 1 THEN (1 - {u('-1')}) ** (1 / {shape}) ELSE 1 END * ({sd}) ** 2 / ({mean}))"


def _cdf_sql(x: str) -> str:
    series = "1"
    for k in range(random.TERMS, 0, -1):
        series = f"(1 + {x} * {x} / {2 * k + 1}.0::DOUBLE * {series})"
    return f"(0.5 + {x} * exp(-0.5 * {x} * {x}) / sqrt(2 * pi()) * {series})"


def trunc_normal_sql(seed: int, key: int, row_id: str, mean: str, sd: str) -> str:
    """The draw of keyed_trunc_normal()."""

    def polynomial(coefficients: tuple[float, ...]) -> str:
        out = f"{coefficients[-1]!r}::DOUBLE"
        for c in reversed(coefficients[:-1]):
            out = f"({out} * r + {c!r}::DOUBLE)"
        return out

    low = f"greatest(-1.0::DOUBLE, coalesce(-({mean}) / nullif({sd}, 0), -1))"
    p = _let_sql(low, "w", _let_sql(_cdf_sql("w"), "a", f"a + {uniform_sql(seed, key, row_id)} * ({_cdf_sql('1.0::DOUBLE')} - a)"))
    z = _let_sql(f"{p} - 0.5", "q", _let_sql("0.180625 - q * q", "r", f"q * {polynomial(random.QUANTILE_OVER)} / {polynomial(random.QUANTILE_UNDER)}"))
    return f"greatest(0, {mean} + {sd} * {z})"


SQL["reduced"] = f"SELECT k.*, p.pmu_a FROM keyed k JOIN params p USING (pathway_i) WHERE p.p_a > {uniform_sql(SEED, 0x100, 'k.synapse_id')}"
SQL["conns"] = "SELECT src, dst, min(pathway_i) AS pathway_i, count(*) AS n, min(synapse_id) AS first_id FROM reduced GROUP BY src, dst"
SQL["survivors"] = f"SELECT * FROM (SELECT c.*, CASE WHEN pmu_a = 0 THEN 1.0 ELSE 1 / (1 + exp(-4 / (pmu_a / 4) * (n - pmu_a))) END AS survival FROM conns c JOIN params p USING (pathway_i) WHERE pmu_a IS NOT NULL) WHERE survival > 0 AND survival > {uniform_sql(SEED, 0x101, 'first_id')}"
SQL["fractions"] = "SELECT pathway_i, left_n / total_touches AS actual, CASE WHEN brf IS NULL THEN active_fraction WHEN brf > left_n / total_touches THEN 1.0 ELSE brf / (left_n / total_touches) END AS fraction FROM (SELECT pathway_i, sum(n) AS left_n FROM survivors GROUP BY pathway_i) JOIN params USING (pathway_i)"
SQL["kept"] = f"SELECT src, dst FROM survivors JOIN fractions USING (pathway_i) WHERE {uniform_sql(SEED, 0x102, 'first_id')} < fraction"

_MIRROR = "CASE WHEN src < dst THEN {0} ELSE {1} END"
SQL |= {
    # numbers of a walk through the trees: lists of ids from the root have its order
    "walks": "SELECT morphology, section_id, [section_id] AS way FROM sections WHERE parent_id IS NULL UNION ALL SELECT s.morphology, s.section_id, list_append(w.way, s.section_id) FROM walks w JOIN sections s ON s.morphology = w.morphology AND s.parent_id = w.section_id",
    "intervals": "SELECT w.morphology, w.section_id, w.enter, w.enter + n - 1 AS leave FROM (SELECT morphology, section_id, row_number() OVER (PARTITION BY morphology ORDER BY way) - 1 AS enter FROM walks) w JOIN (SELECT morphology, ancestor_id, count(*) AS n FROM above GROUP BY ALL) a ON a.morphology = w.morphology AND a.ancestor_id = w.section_id",
    # greedy matching, an edge of each place a step
    "mirrored": f"SELECT synapse_id, src < dst AS forward, least(src, dst) AS a, greatest(src, dst) AS b, {_MIRROR.format('efferent_section_id', 'afferent_section_id')} AS s1, {_MIRROR.format('afferent_section_id', 'efferent_section_id')} AS s2, {_MIRROR.format('efferent_segment_id', 'afferent_segment_id')} AS g1, {_MIRROR.format('afferent_segment_id', 'efferent_segment_id')} AS g2 FROM redges WHERE src <> dst",
    "waiting": "SELECT a, b, s1, s2, list(struct_pack(id := synapse_id, g1 := g1, g2 := g2) ORDER BY synapse_id) FILTER (forward) AS ones, list(struct_pack(id := synapse_id, g1 := g1, g2 := g2) ORDER BY synapse_id) FILTER (NOT forward) AS others FROM mirrored GROUP BY a, b, s1, s2",
    "greedy": "SELECT a, b, s1, s2, ones, others, 0 AS step, CAST(NULL AS BIGINT) AS one, CAST(NULL AS BIGINT) AS other, CAST(NULL AS BIGINT) AS g1, CAST(NULL AS BIGINT) AS g2 FROM waiting WHERE ones IS NOT NULL AND others IS NOT NULL UNION ALL SELECT a, b, s1, s2, ones, list_filter(others, lambda x: pick IS NULL OR x.id <> pick), step + 1, i.id, pick, i.g1, i.g2 FROM (SELECT *, coalesce(list_filter(others, lambda x: x.g1 = i.g1 AND x.g2 = i.g2)[1].id, list_filter(others, lambda x: abs(x.g1 - i.g1) <= 1 AND abs(x.g2 - i.g2) <= 1)[1].id) AS pick FROM (SELECT a, b, s1, s2, ones, others, step, ones[step + 1] AS i FROM greedy WHERE step < len(ones)))",
    "partners": "SELECT one AS synapse_id, other AS partner, g1 AS out_segment, g2 AS in_segment FROM greedy WHERE other IS NOT NULL UNION ALL SELECT other, one, g2, g1 FROM greedy WHERE other IS NOT NULL",
    "matched": "SELECT r.src, r.dst, r.synapse_id, r.efferent_section_id, r.afferent_section_id, p.out_segment, p.in_segment, p.partner, 'M' || r.src AS morphology FROM redges r JOIN partners p ON p.synapse_id = r.synapse_id",
    # an edge drops where a later one of its connection is near on its section or below it
    "rooted": "SELECT * FROM matched WHERE efferent_section_id = 0 OR afferent_section_id = 0",
    "placed": "SELECT m.*, d.root_distance, q.radius FROM rooted m JOIN (SELECT src, dst FROM rooted GROUP BY src, dst HAVING arg_min(afferent_section_id, synapse_id) = 0) o ON o.src = m.src AND o.dst = m.dst LEFT JOIN rootdist d ON d.morphology = m.morphology AND d.section_id = m.efferent_section_id AND d.idx = m.out_segment LEFT JOIN radii q ON q.morphology = m.morphology",
    "dropped": "SELECT DISTINCT i.synapse_id FROM placed i JOIN placed k ON k.src = i.src AND k.dst = i.dst AND k.synapse_id > i.synapse_id JOIN above v ON v.morphology = k.morphology AND v.section_id = k.efferent_section_id AND v.ancestor_id = i.efferent_section_id WHERE abs(k.root_distance - i.root_distance) < 3 * k.radius",
    "staying": "SELECT synapse_id, partner FROM placed WHERE synapse_id NOT IN (SELECT synapse_id FROM dropped)",
    "junctions": "SELECT * FROM matched WHERE (efferent_section_id <> 0 AND afferent_section_id <> 0) OR synapse_id IN (SELECT synapse_id FROM staying UNION SELECT partner FROM staying)",
}

_NEEDS = {"intervals": ["walks", "above"], "walks": ["sections"], "mirrored": ["redges"], "waiting": ["mirrored"], "greedy": ["waiting"], "partners": ["greedy"], "matched": ["redges", "partners"], "rooted": ["matched"], "placed": ["rooted", "rootdist", "radii"], "dropped": ["placed", "above"], "staying": ["placed", "dropped"], "junctions": ["matched", "staying"], "dstn": ["dtypes"], "circuit": ["edges", "srcn", "dstn"], "keyed": ["circuit"], "stats": ["keyed"], "paths": ["points"], "lengths": ["paths"], "above": ["sections"], "rootdist": ["above", "lengths", "paths"], "radii": ["points"], "firstsec": ["sections", "rootdist"], "tcells": ["trules", "dtypes", "kinds"], "rulep": ["crules", "dtypes"], "params0": ["stats", "rulep"], "params1": ["params0"], "params2": ["params1"], "solve0": ["params1"], "solve1": ["solve0"], "solve2": ["solve1"], "solved": ["solve2"], "params": ["params2", "solved"], "reduced": ["keyed", "params"], "conns": ["reduced"], "survivors": ["conns"], "fractions": ["survivors", "params"], "kept": ["fractions", "survivors"]}


def with_sql(*names: str, instead: dict[str, tuple[str, list[str]]] | None = None) -> str:
    """A WITH clause of the named tables and all that they need, in order; instead has other SQL, and what that needs, for some."""
    order: list[str] = []
    sql, needs = dict(SQL), dict(_NEEDS)
    for name, (text, own) in (instead or {}).items():
        sql[name], needs[name] = text, own

    def add(name: str) -> None:
        for other in needs.get(name, ()):
            add(other)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({sql[n]})" for n in order) + " "
