"""Path lengths and distances to the root in trees of sections.

sections(morphology, section_id, parent_id, type) has a root with a null parent_id; points(morphology,
section_id, idx, x, y, z) is the polyline of each section.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgeworks.sources.checkpoint import checkpoint, written

from .model import dealt as _dealt

#: Longest way to a root; a longer one is a cycle.
DEEPEST = 10_000
#: Rows of either side of a join of ways and jumps that a task has on average.
TASK_ROWS = 250_000


def path_lengths(points: DataFrame) -> DataFrame:
    """points with path_length: length of the polyline up to each point."""
    w = Window.partitionBy("morphology", "section_id").orderBy("idx")
    step = F.sqrt(sum((F.col(c) - F.lag(c).over(w)) ** 2 for c in ("x", "y", "z")))
    return points.withColumn("step", F.coalesce(step, F.lit(0.0))).withColumn("path_length", F.sum("step").over(w)).drop("step")


def section_lengths(points: DataFrame) -> DataFrame:
    return path_lengths(points).groupBy("morphology", "section_id").agg(F.max("path_length").alias("length"))


def ancestors(sections: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """(morphology, section_id, ancestor_id, depth): each section, or those of (morphology, section_id), with itself and all sections on its way to the root.

    Doubling: a table of ways of length up to 2**k and of jumps of exactly 2**k, so the number of
    joins is the logarithm of the deepest tree. The ways and jumps that a round finds are written once and counted there; the next round
    deals them by these counts, as rows that pack well would else be put together in tasks by their packed bytes.
    The result has a row for each section and ancestor; what needs only sums or tests takes path_sums() or section_intervals().
    """
    n, place = F.count("*"), ["morphology", "ancestor_id"]

    def spread(df: DataFrame, tasks: int) -> DataFrame:
        return df.repartition(tasks, *place) if tasks > 1 else df

    jumps, jumped = written(sections.where("parent_id IS NOT NULL").select("morphology", "section_id", F.col("parent_id").alias("ancestor_id")), n=n)
    chosen = sections if of is None else sections.join(_dealt(of.select("morphology", "section_id")), ["morphology", "section_id"], "left_semi")
    ways, found = written(chosen.select("morphology", "section_id", F.col("section_id").alias("ancestor_id"), F.lit(0).alias("depth")), n=n)
    reach, rows = 1, found["n"]
    while jumped["n"]:
        if reach > DEEPEST:
            raise ValueError("sections form a cycle")
        tasks = max(rows, jumped["n"]) // TASK_ROWS + 1
        onward = _dealt(spread(jumps.select("morphology", F.col("section_id").alias("ancestor_id"), F.col("ancestor_id").alias("next_id")), tasks))
        longer, found = written(spread(ways, tasks).join(onward, place).select("morphology", "section_id", F.col("next_id").alias("ancestor_id"), (F.col("depth") + reach).alias("depth")), n=n)
        jumps, jumped = written(spread(jumps, tasks).join(onward, place).select("morphology", "section_id", F.col("next_id").alias("ancestor_id")), n=n)
        ways, rows, reach = ways.unionByName(longer), rows + found["n"], 2 * reach
    return ways


def _jumped(state: DataFrame, values: list[str]) -> DataFrame:
    """Each section's pointer moved on to where the section there points, with what that one has gathered added to its own."""
    onward = state.select("morphology", F.col("section_id").alias("to"), F.col("to").alias("next"), *[F.col(v).alias(f"next_{v}") for v in values])
    # a section that has arrived meets nothing: it would only crowd the exchange with null keys
    moved = state.where("to IS NOT NULL").join(_dealt(onward), ["morphology", "to"], "left")
    moved = moved.select("morphology", "section_id", F.col("next").alias("to"), *[(F.col(v) + F.coalesce(f"next_{v}", F.lit(0))).alias(v) for v in values])
    return state.where("to IS NULL").select(*moved.columns).unionByName(moved)


def _rounds(state: DataFrame, move: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """state after as many moves as its pointers need to arrive; each round is written once, and has one row a section."""
    metrics = {"n": F.count("*"), "open": F.count_if(F.col("to").isNotNull())}
    state, seen = written(state, **metrics)
    most = seen["n"].bit_length()
    while seen["open"]:
        if most < 0:
            raise ValueError("sections form a cycle")
        state, seen = written(move(state), **metrics)
        most -= 1
    return state.drop("to")


def path_sums(sections: DataFrame, *values: str) -> DataFrame:
    """(morphology, section_id, values): for each section the sums of the values over all sections above it, the root included.

    Pointer jumping: in each round a section's pointer jumps as far again as it has come, and takes the sum over what it passes. So
    there are as many rounds as the depth has binary digits, and never more rows than sections. The children of
    a root have arrived from the start, so no round sends all sections to their root. A parent that is not there ends the way.
    """
    above = sections.select("morphology", F.col("section_id").alias("parent_id"), F.col("parent_id").alias("to"), *values)
    start = sections.select("morphology", "section_id", "parent_id").join(_dealt(above), ["morphology", "parent_id"], "left")
    start = start.withColumn("to", F.when(F.col("to").isNotNull(), F.col("parent_id"))).select("morphology", "section_id", "to", *[F.coalesce(v, F.lit(0)).alias(v) for v in values])
    return _rounds(start, lambda state: _jumped(state, list(values)))


def subtree_sizes(sections: DataFrame) -> DataFrame:
    """(morphology, section_id, size): the sections at or below each, by pointers that jump to the root while each section adds what it has gathered to where it points."""

    def move(state: DataFrame) -> DataFrame:
        given = state.where("to IS NOT NULL").groupBy("morphology", F.col("to").alias("section_id")).agg(F.sum("size").alias("given"))
        moved = _jumped(state, []).join(_dealt(state.select("morphology", "section_id", "size")), ["morphology", "section_id"])
        return moved.join(_dealt(given), ["morphology", "section_id"], "left").withColumn("size", F.col("size") + F.coalesce("given", F.lit(0))).drop("given")

    # a parent that is not there gathers nothing
    known = sections.select("morphology", F.col("section_id").alias("parent_id"), F.col("section_id").alias("to"))
    return _rounds(sections.join(_dealt(known), ["morphology", "parent_id"], "left").select("morphology", "section_id", "to", F.lit(1).cast("long").alias("size")), move)


def section_intervals(sections: DataFrame) -> DataFrame:
    """(morphology, section_id, enter, leave): numbers in the order in which a tree is walked, children by id.

    Section a is b or above b just if a.enter <= b.enter <= a.leave, so no list of ancestors is needed. A section comes after its
    parent and what is below the siblings before it, which subtree sizes tell; the sums over the path above it do the rest.
    """
    sized, _ = written(sections.select("morphology", "section_id", "parent_id").join(_dealt(subtree_sizes(sections)), ["morphology", "section_id"]))
    before = Window.partitionBy("morphology", "parent_id").orderBy("section_id").rowsBetween(Window.unboundedPreceding, -1)
    step = F.coalesce(F.sum("size").over(before), F.lit(0)) + F.when(F.col("parent_id").isNull(), 0).otherwise(1)
    stepped, _ = written(sized.withColumn("step", step))
    found = stepped.join(_dealt(path_sums(stepped, "step").withColumnRenamed("step", "above")), ["morphology", "section_id"])
    enter = F.col("above") + F.col("step")
    return found.select("morphology", "section_id", enter.alias("enter"), (enter + F.col("size") - 1).alias("leave"))


def lengths_before(sections: DataFrame, points: DataFrame) -> DataFrame:
    """(morphology, section_id, before): length of all ancestor sections but the root itself, which is the body; ways start at its surface."""
    known = sections.select("morphology", "section_id", "parent_id").join(_dealt(section_lengths(points)), ["morphology", "section_id"], "left")
    long = F.when(F.col("parent_id").isNotNull(), F.coalesce("length", F.lit(0.0))).otherwise(0.0)
    return path_sums(known.withColumn("before", long), "before")


def root_distances(sections: DataFrame, points: DataFrame) -> DataFrame:
    """(morphology, section_id, idx, root_distance): own path length plus all ancestor sections but the root itself."""
    own = path_lengths(points).join(_dealt(lengths_before(sections, points)), ["morphology", "section_id"], "left")
    return own.select("morphology", "section_id", "idx", (F.coalesce("before", F.lit(0.0)) + F.col("path_length")).alias("root_distance"))


def root_radii(sections: DataFrame, points: DataFrame) -> DataFrame:
    """(morphology, radius): the farthest root point from the root's centre, the mean of its points."""
    root = points.join(_dealt(sections.where("parent_id IS NULL").select("morphology", "section_id")), ["morphology", "section_id"])
    centre = root.groupBy("morphology").agg(*[F.avg(c).alias(f"c{c}") for c in ("x", "y", "z")])
    away = F.sqrt(sum((F.col(c) - F.col(f"c{c}")) ** 2 for c in ("x", "y", "z")))
    return root.join(_dealt(centre), "morphology").groupBy("morphology").agg(F.max(away).alias("radius"))


def first_section(sections: DataFrame, points: DataFrame, kind: int, reach: float = 0.5) -> DataFrame:
    """(morphology, section_id, offset, fraction, root_distance): a place near the start of the first section of a kind.

    offset is the end of the first segment, reach at most.
    """
    first = checkpoint(sections.where(F.col("type") == kind).groupBy("morphology").agg(F.min("section_id").alias("section_id")))
    own = points.join(_dealt(first), ["morphology", "section_id"], "left_semi")
    span = path_lengths(own).groupBy("morphology", "section_id").agg(F.max(F.when(F.col("idx") == 1, F.col("path_length"))).alias("segment"), F.max("path_length").alias("length"))
    # trees without such a section are not measured
    before = lengths_before(sections.join(_dealt(first), "morphology", "left_semi"), points.join(_dealt(first), "morphology", "left_semi"))
    offset = F.least(F.lit(reach), F.col("segment"))
    start = F.coalesce("before", F.lit(0.0))
    return span.join(_dealt(before), ["morphology", "section_id"], "left").select("morphology", "section_id", offset.alias("offset"), F.try_divide(offset, F.col("length")).alias("fraction"), (start + offset).alias("root_distance"))
