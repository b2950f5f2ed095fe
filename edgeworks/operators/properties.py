"""Filters on distances, repositioning, and properties that are drawn once a connection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeworks.functions.random import check_params, keyed_gamma, keyed_poisson, keyed_trunc_normal

from .model import dealt

AXON = 1
# fixed values: property, key of its random numbers, and how it is drawn
DRAWS = (
    ("conductance", 0x1001, "gamma"),
    ("depression_time", 0x1002, "gamma"),
    ("facilitation_time", 0x1003, "gamma"),
    ("u_syn", 0x1004, "truncated_normal"),
    ("decay_time", 0x1005, "truncated_normal"),
    ("n_rrp_vesicles", 0x1006, "poisson"),
)


def class_threshold(df: DataFrame, distance: str, class_code: str, least: dict[int, float]) -> DataFrame:
    """Rows at least as far as their class asks for; other classes go."""
    tests = [(F.col(class_code) == code) & (F.col(distance) >= F.lit(float(x))) for code, x in sorted(least.items())]
    return df.where(reduce(lambda a, b: a | b, tests, F.lit(False)))


def min_distance_by_key(df: DataFrame, radii: DataFrame, distance: str = "distance_soma", key: str = "dst_morphology") -> DataFrame:
    """Rows at least as far as the radius of their morphology; without a radius they go."""
    limits = radii.select(F.col("morphology").alias(key), F.col("radius").alias("__radius"))
    return df.join(dealt(limits), key).where(F.col(distance) >= F.col("__radius")).select(*df.columns)


def reposition(df: DataFrame, covered: DataFrame, columns: list[str], targets: DataFrame, key: str = "src_morphology") -> DataFrame:
    """Move edges whose codes are in covered to the target on their axon; all others stay as they are."""
    flags = covered.select(*columns).distinct().withColumn("__moved", F.lit(True))
    places = targets.select(F.col("morphology").alias(key), F.col("section_id").alias("__section"), F.col("offset").alias("__offset"), F.col("fraction").alias("__fraction"), F.col("root_distance").alias("__root"))
    joined = df.join(flags, columns, "left").join(dealt(places), key, "left")
    moved = F.coalesce("__moved", F.lit(False)) & F.col("__section").isNotNull()
    new = {"afferent_section_id": F.col("__section"), "afferent_section_type": F.lit(AXON), "afferent_segment_id": F.lit(0), "afferent_segment_offset": F.col("__offset"), "afferent_section_pos": F.col("__fraction"), "distance_soma": F.col("__root")}
    always = {"afferent_segment_offset": F.lit(None).cast("double")}
    present = {c: v for c, v in new.items() if c in df.columns or c in always}
    base = {c: F.col(c) if c in df.columns else always[c] for c in present}
    types = dict(df.dtypes)
    changed = {c: F.when(moved, v.cast(types.get(c, "double"))).otherwise(base[c]) for c, v in present.items()}
    return joined.withColumns(changed).select(*df.columns, *[c for c in present if c not in df.columns])


def draw_properties(connections: DataFrame, seed: int) -> DataFrame:
    """connections with a column for each property whose *_mu (and *_sd) they have; first_id keys the draws."""
    out: dict[str, Column] = {}
    for name, key, kind in DRAWS:
        if f"{name}_mu" not in connections.columns:
            continue
        mean = F.col(f"{name}_mu")
        if kind == "poisson":
            out[name] = keyed_poisson(seed, key, F.col("first_id"), mean).cast("short")
        else:
            draw = keyed_gamma if kind == "gamma" else keyed_trunc_normal
            out[name] = draw(seed, key, F.col("first_id"), mean, F.col(f"{name}_sd"))
    return connections.withColumns(out)


def check_classes(classes: DataFrame) -> None:
    """Reject classes whose parameters no draw can satisfy; there are few of them, however many rows have them."""
    for row in classes.select(*[c for c in classes.columns if c.endswith(("_mu", "_sd"))]).distinct().collect():
        for name, _, kind in DRAWS:
            if kind != "poisson" and f"{name}_mu" in row and None not in (row[f"{name}_mu"], row[f"{name}_sd"]):
                check_params(row[f"{name}_mu"], row[f"{name}_sd"], kind)


def connection_properties(df: DataFrame, params: DataFrame, seed: int) -> DataFrame:
    """df with the properties of its connection. params has class_i and the distributions by pathway_i.

    Numbers are drawn on one row a connection, keyed by its least id; the edges get them by a join.
    Classes that no draw can satisfy are an error.
    """
    check_classes(params)
    connections = df.groupBy("src", "dst").agg(F.min("synapse_id").alias("first_id"), F.min("pathway_i").alias("pathway_i"))
    drawn = draw_properties(connections.join(params, "pathway_i"), seed)
    names = [c for c in drawn.columns if c not in ("first_id", "pathway_i") and not c.endswith(("_mu", "_sd"))]
    return df.join(drawn.select(*names), ["src", "dst"])


def derive_properties(df: DataFrame, default_release_delay: float = 0.1) -> DataFrame:
    """delay from distance and velocity, and the type ids of the class."""
    out: dict[str, Column] = {"syn_type_id": F.when(F.col("class").startswith("E"), 100).otherwise(0).cast("short"), "syn_property_rule": F.col("class_i").cast("short")}
    gone = ["class", "class_i", "neural_transmitter_release_delay", "axonal_conduction_velocity"]
    if "distance_soma" in df.columns:
        release = F.coalesce("neural_transmitter_release_delay", F.lit(default_release_delay))
        out["delay"] = (release + F.col("distance_soma") / F.col("axonal_conduction_velocity")).cast("float")
        gone.append("distance_soma")
    return df.withColumns(out).drop(*gone)


def with_conductance(df: DataFrame, conductance: float = 0.2) -> DataFrame:
    return df.withColumn("conductance", F.lit(float(conductance)))
