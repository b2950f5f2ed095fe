"""Numbering of edges without a global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeworks.sources.checkpoint import checkpoint


def running(df: DataFrame, order: list[str], value: str, into: str, function=F.sum) -> DataFrame:
    """df with the running sum (or maximum) of value over all rows in this order, the row itself included.

    Ranges of the order become partitions, so no task holds all rows: each range has its own running
    value, and what the ranges before it come to is a table of one row a range.
    """
    ranges = checkpoint(df.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    whole = ranges.groupBy("range").agg(function(value).alias("whole"))
    # one row a range
    before = whole.select("range", function("whole").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    own = function(value).over(Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    both = F.coalesce(F.col("before") + F.col(into), F.col(into)) if function is F.sum else F.greatest("before", into)
    return ranges.withColumn(into, own).join(before, "range").withColumn(into, both).drop("range", "before")


def connection_offsets(df: DataFrame) -> DataFrame:
    """(src, dst, offset): edges in all connections before, by src and then dst.

    The running sum is over one row a connection.
    """
    pairs = df.groupBy("src", "dst").agg(F.count("*").alias("n"))
    return running(pairs, ["src", "dst"], "n", "upto").select("src", "dst", (F.col("upto") - F.col("n")).alias("offset"))


def dense_id(df: DataFrame, order: list[str | Column], into: str = "synapse_id") -> DataFrame:
    """df with ids 0 .. N-1 by src, dst and the given order."""
    numbered = df.withColumn("__place", F.row_number().over(Window.partitionBy("src", "dst").orderBy(*order)))
    joined = numbered.join(connection_offsets(df), ["src", "dst"])
    return joined.withColumn(into, F.col("offset") + F.col("__place") - 1).drop("__place", "offset")


def connection_id(df: DataFrame, into: str = "synapse_id") -> DataFrame:
    """One id for all edges of a connection: the edges in connections before it, less one."""
    return df.join(connection_offsets(df), ["src", "dst"]).withColumn(into, F.col("offset") - 1).drop("offset")
