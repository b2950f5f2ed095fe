"""Named sets of nodes: attributes and values, or other sets by name.

A set is an object of attributes that must all fit, or a list of names of sets, of which one must. An attribute fits a value, one of a list of
values, or an object of comparisons ($gt, $gte, $lt, $lte, $regex). node_id stands for the id. A null attribute fits nothing.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_COMPARE = {"$gt": lambda c, x: c > x, "$gte": lambda c, x: c >= x, "$lt": lambda c, x: c < x, "$lte": lambda c, x: c <= x, "$regex": lambda c, x: c.rlike(f"^(?:{x})$")}


def read_nodesets(spark: SparkSession, path: str) -> dict[str, object]:
    """The sets of a JSON file, by name."""
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


def members(sets: Mapping[str, object], name: str) -> list[str]:
    """Names of the plain sets that a set comes down to, each once. Unknown names and cycles are errors."""
    out: dict[str, None] = {}
    done: set[str] = set()

    def follow(at: str, path: tuple[str, ...]) -> None:
        if at in path:
            raise ValueError(f"nodesets form a cycle: {' > '.join((*path, at))}")
        if at not in sets:
            raise ValueError(f"no nodeset {at!r}")
        if at in done:
            return
        done.add(at)
        if isinstance(sets[at], list):
            for part in sets[at]:
                follow(part, (*path, at))
        else:
            out[at] = None

    follow(name, ())
    return list(out)


def _fits(column: Column, wanted: object) -> Column:
    if isinstance(wanted, Mapping):
        if unknown := wanted.keys() - _COMPARE.keys():
            raise ValueError(f"no comparison {sorted(unknown)}")
        return reduce(lambda a, b: a & b, [_COMPARE[k](column, x) for k, x in wanted.items()], F.lit(True))
    if isinstance(wanted, list):
        return column.isin(wanted) if wanted else F.lit(False)
    return column == F.lit(wanted)


def predicate(sets: Mapping[str, object], name: str, columns: list[str]) -> Column:
    """Whether a node with these columns is in the named set. A set without attributes holds all nodes, and one of an attribute that nodes lack is an error."""

    def plain(rules: Mapping[str, object]) -> Column:
        tests = []
        for attribute, wanted in rules.items():
            column = "id" if attribute == "node_id" else attribute
            if column not in columns:
                raise ValueError(f"nodes have no attribute {attribute!r}")
            tests.append(_fits(F.col(f"`{column}`"), wanted))
        return reduce(lambda a, b: a & b, tests, F.lit(True))

    one_of = reduce(lambda a, b: a | b, [plain(sets[n]) for n in members(sets, name)], F.lit(False))
    return F.coalesce(one_of, F.lit(False))


def named_nodes(nodes: DataFrame, sets: Mapping[str, object], name: str) -> DataFrame:
    """The nodes of the named set."""
    return nodes.where(predicate(sets, name, nodes.columns))
