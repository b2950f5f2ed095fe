"""Comparisons of results, counts by stage, and invariants."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def pathway_diff(base: DataFrame, comp: DataFrame, keys: list[str], least_abs: float, least_rel: float) -> DataFrame:
    """Pathways whose edge counts differ by more than both limits, labelled changed, added or lost."""
    if base.columns != comp.columns and set(base.columns) != set(comp.columns):
        raise ValueError(f"columns differ: {sorted(set(base.columns) ^ set(comp.columns))}")
    counts = [df.groupBy(*keys).agg(F.count("*").alias(name)) for df, name in ((base, "base"), (comp, "comp"))]
    both = counts[0].join(counts[1], keys, "full_outer").na.fill(0, ["base", "comp"])
    difference = F.abs(F.col("base") - F.col("comp"))
    both = both.withColumns({"diff_abs": difference, "diff_rel": difference / F.greatest("base", "comp")})
    label = F.when(F.col("base") == 0, "added").when(F.col("comp") == 0, "lost").otherwise("changed")
    return both.where((F.col("diff_abs") > least_abs) & (F.col("diff_rel") > least_rel)).withColumn("label", label)


def nodeset_check(full: DataFrame, filtered: DataFrame, ids: DataFrame) -> DataFrame:
    """One row: edges of full with both ends among ids, rows of filtered, and whether they agree."""
    inside = full.join(ids.select(F.col("id").alias("src")), "src", "left_semi").join(ids.select(F.col("id").alias("dst")), "dst", "left_semi")
    counts = inside.agg(F.count("*").alias("expected")).crossJoin(filtered.agg(F.count("*").alias("found")))
    return counts.withColumn("same", F.col("expected") == F.col("found"))


def cut_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Edges by pathway_str and stage, in one frame."""
    out = None
    for name, df in stages.items():
        counts = df.groupBy("pathway_str").agg(F.count("*").alias("n")).withColumn("stage", F.lit(name))
        out = counts if out is None else out.unionByName(counts)
    return out


def property_invariants(df: DataFrame, columns: list[str], numbers: list[str] = (), agrees: Column | None = None) -> DataFrame:
    """(src, dst, n_sets, n_negative, n_mismatched): sets of properties of a connection, of which there should be one, and its edges with a negative number or whose class does not agree.

    Edges are counted by set before the shuffle, so a connection of many edges sends few rows. A null number is not negative, and a null agreement is none.
    """
    negative = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) < 0, F.lit(False)) for c in numbers], F.lit(False))
    mismatched = F.lit(False) if agrees is None else ~F.coalesce(agrees, F.lit(False))
    sets = df.groupBy("src", "dst", *columns).agg(F.count_if(negative).alias("negative"), F.count_if(mismatched).alias("mismatched"))
    return sets.groupBy("src", "dst").agg(F.count("*").alias("n_sets"), F.sum("negative").alias("n_negative"), F.sum("mismatched").alias("n_mismatched"))


def eventlog_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(app, max_shuffle, max_rows, last_rows) from Spark event logs, by file: the largest shuffle and
    row counts of a completed stage, and the last row count over zero.
    """
    schema = "Event string, `Stage Info` struct<`Stage ID`:long, `Completion Time`:long, Accumulables:array<struct<Name:string, Value:string>>>"
    stages = spark.read.schema(schema).json(path).where("Event = 'SparkListenerStageCompleted'").select(F.input_file_name().alias("app"), F.col("`Stage Info`.`Stage ID`").alias("stage"), F.col("`Stage Info`.`Completion Time`").alias("time"), F.explode("`Stage Info`.Accumulables").alias("a"))
    value = F.try_to_number(F.col("a.Value"), F.lit("999999999999999999")).cast("long")
    of = lambda *names: F.coalesce(F.sum(F.when(F.col("a.Name").isin(*names), value)), F.lit(0).cast("long"))
    read = of("internal.metrics.shuffle.read.remoteBytesRead", "internal.metrics.shuffle.read.localBytesRead")
    by_stage = stages.groupBy("app", "stage", "time").agg(read.alias("read"), of("internal.metrics.shuffle.write.bytesWritten").alias("written"), of("number of output rows").alias("rows"))
    last = F.max_by(F.when(F.col("rows") > 0, F.col("rows")), F.when(F.col("rows") > 0, F.struct("time", "stage")))
    return by_stage.groupBy("app").agg(F.max(F.greatest("read", "written")).alias("max_shuffle"), F.max("rows").alias("max_rows"), last.alias("last_rows"))
