"""Edges joined with their node tables, and pathways over categorical node attributes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Nodes of a table that Spark may send to all tasks; more are dealt by id.
MOST_SENT = 100_000


def dealt(df: DataFrame) -> DataFrame:
    """df as the side of a join that is dealt by its key and sorted. Rows that are exploded, or packed well in their files, are far more than Spark's estimate says, which would send them whole to the driver for a broadcast."""
    return df.hint("merge")


def assemble(edges: DataFrame, source: DataFrame, target: DataFrame, node_id: str = "id") -> DataFrame:
    """Edges with the attributes of both ends as src_* and dst_*; an edge without an end vanishes."""

    def side(nodes: DataFrame, name: str) -> DataFrame:
        named = nodes.withColumnsRenamed({c: name if c == node_id else f"{name}_{c}" for c in nodes.columns})
        return dealt(named) if nodes.select(node_id).limit(MOST_SENT + 1).count() > MOST_SENT else named

    return edges.join(side(source, "src"), "src").join(side(target, "dst"), "dst")


def edges_only(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if not c.startswith(("src_", "dst_"))])


def reassemble(df: DataFrame, source: DataFrame, target: DataFrame) -> DataFrame:
    """A frame with node attributes stays as it is; bare edges are joined again."""
    return df if edges_only(df).columns != df.columns else assemble(df, source, target)


def code_column(df: DataFrame, name: str) -> str:
    """src_x stands for src_x_i where only the codes are there."""
    return name if name in df.columns else f"{name}_i"


def pathway_key(df: DataFrame, columns: list[str], sizes: list[int]) -> Column:
    """Mixed-radix number of the codes; a code outside its size gives null rather than another pathway."""
    codes = [F.col(code_column(df, c)).cast("long") for c in columns]
    key = reduce(lambda total, part: total * F.lit(part[1]) + part[0], zip(codes, sizes, strict=True), F.lit(0).cast("long"))
    valid = reduce(lambda a, b: a & b, [(c >= 0) & (c < n) for c, n in zip(codes, sizes, strict=True)])
    return F.when(valid, key)


def with_pathway(df: DataFrame, columns: list[str], sizes: list[int]) -> DataFrame:
    """df with pathway_i and a printable pathway_str."""
    text = F.format_string(", ".join(f"{c}=%d" for c in columns), *[F.col(code_column(df, c)) for c in columns])
    return df.withColumns({"pathway_i": pathway_key(df, columns, sizes), "pathway_str": text})


def pathway_stats(df: DataFrame) -> DataFrame:
    """Touches, connections and mean touches per connection of each pathway.

    Counting per connection first lets every map task combine its rows, and leaves the second
    grouping one row a connection.
    """
    connections = df.groupBy("pathway_i", "src", "dst").agg(F.count("*").alias("n"))
    stats = connections.groupBy("pathway_i").agg(F.sum("n").alias("total_touches"), F.count("*").alias("total_connections"))
    return stats.withColumn("structural_mean", F.col("total_touches") / F.col("total_connections"))


def check_columns(before: DataFrame, after: DataFrame, dropped: set[str] = frozenset(), added: set[str] = frozenset(), optional: set[str] = frozenset()) -> DataFrame:
    """after, if it differs from before in exactly the declared columns."""
    gone, new = set(before.columns) - set(after.columns), set(after.columns) - set(before.columns)
    wrong = (gone ^ dropped) - optional | (new ^ (added - set(before.columns))) - optional
    if wrong:
        raise ValueError(f"undeclared or missing column changes: {sorted(wrong)}")
    return after
