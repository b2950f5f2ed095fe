"""Connected components of a distributed edge list by alternating large and small stars.

Each round is a grouped minimum and a join on the node, so no group is gathered anywhere: the
minimum is combined before the shuffle, and the minima of hot nodes are broadcast. Rounds are cut
with checkpoints in the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import checkpoint, stored


#: Keys with more than one row in so many are joined by broadcast: there are fewer of them than this.
HOT = 200


def join_hot(rows: DataFrame, facts: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """rows joined (inner or left) with facts(key, n and others) on key, without n, the number of rows with that key.

    A key with over 1/HOT of all rows would land in one task, so these, fewer than HOT, are broadcast and
    their rows stay where they are; the others meet by a shuffle. Null keys meet nothing.
    """
    facts = stored(facts)
    total = facts.agg(F.sum("n")).first()[0] or 0
    rest = facts.where(F.col("n") * HOT <= total).drop("n")
    hot = facts.where(F.col("n") * HOT > total).drop("n")
    known = [r[0] for r in hot.select(key).distinct().collect()]
    if not known:
        return rows.join(rest, key, how)
    is_hot = F.coalesce(F.col(key).isin(known), F.lit(False))
    return rows.where(is_hot).join(F.broadcast(hot), key, how).unionByName(rows.where(~is_hot).join(rest, key, how))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the larger (large star) or smaller (small star) neighbours of each node to its least neighbour."""
    if large:
        sides = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    else:
        sides = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
    least = sides.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"), F.count("*").alias("n"))
    joined = join_hot(sides, least, "node")
    if large:
        out = joined.where("other > node").select(F.col("other").alias("a"), F.col("least").alias("b"))
    else:
        out = joined.where("other <> least").select(F.col("other").alias("a"), F.col("least").alias("b")).union(joined.select(F.col("node").alias("a"), F.col("least").alias("b")))
    return out.where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges(a, b); root is the component's least node. Ends when two rounds agree."""
    edges = checkpoint(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    last = None
    while True:
        # equal sums of an order-free hash, with equal counts, mark a fixed point
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == last or now[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b"), F.col("b"))).distinct()
        last = now
        edges = checkpoint(_star(_star(edges, True), False))
