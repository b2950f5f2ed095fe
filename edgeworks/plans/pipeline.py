"""Operators in order, with fingerprinted checkpoints between them."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from edgeworks.operators.model import check_columns
from edgeworks.sources.tables import POST, checkpointed, checkpointed_table, exists, export, fingerprint, load_edges, overlaps, provenance

VERSION = "2"


@dataclass(frozen=True)
class Step:
    """A named function on the edges, with what identifies its parameters and which columns it changes."""

    name: str
    apply: Callable[[DataFrame], DataFrame]
    parameters: object = None
    dropped: frozenset[str] = field(default_factory=frozenset)
    added: frozenset[str] = field(default_factory=frozenset)
    checkpoint: bool = False
    #: Whether rows may go; one that keeps them all is checked where it is checkpointed.
    reductive: bool = True
    #: Columns that the checkpoint is bucketed and sorted by, as a table, and the number of its buckets.
    bucket_by: tuple[str, ...] = ()
    buckets: int = 200


#: Presets: names of the operators in their order. Steps that a caller has no rules for are left out.
STRUCTURAL = ("bouton_distance", "touch_rules")
FUNCTIONAL = ("bouton_distance", "touch_rules", "spine_length", "reduce_and_cut", "reposition", "synapse_properties")
GAP_JUNCTIONS = ("soma_distance", "gap_junction", "dense_id", "gap_junction_properties")
MERGE = ("edge_merge",)


def preset(names: Sequence[str], steps: dict[str, Step], optional: Sequence[str] = ("spine_length", "reposition")) -> list[Step]:
    """The steps of a preset; a missing one is an error unless it is optional."""
    if missing := [n for n in names if n not in steps and n not in optional]:
        raise ValueError(f"no step for {missing}")
    return [steps[n] for n in names if n in steps]


def merge(spark: SparkSession, paths: list[str], out: str, order: tuple[str, ...] = POST) -> DataFrame:
    """Merge mode: several edge files become one, without nodes or rules. Files that have edges in common are refused, since these would be there twice."""
    if twice := overlaps(spark, paths).limit(1).collect():
        raise ValueError(f"inputs {twice[0]['inputs']} overlap: both have the edge {twice[0]['synapse_id']} from {twice[0]['src']} to {twice[0]['dst']}")
    edges, metadata = load_edges(spark, paths)
    export(edges, out, order, provenance(metadata, VERSION, list(MERGE), "", {}))
    return spark.read.parquet(out)


def _there(spark: SparkSession, step: Step, state: str) -> bool:
    return spark.catalog.tableExists(_table(state)) if step.bucket_by else exists(spark, state)


def _table(state: str) -> str:
    return "state_" + re.sub(r"\W", "_", state.rsplit("/", 1)[-1])


def _load(spark: SparkSession, step: Step, state: str) -> DataFrame:
    return spark.table(_table(state)) if step.bucket_by else spark.read.parquet(state)


def _save(spark: SparkSession, step: Step, df: DataFrame, state: str) -> tuple[DataFrame, bool]:
    """df from its checkpoint, and whether it is there; a state that can't be written is logged, and df goes on as it is."""
    try:
        if step.bucket_by:
            return checkpointed_table(spark, lambda: df, _table(state), list(step.bucket_by), step.buckets, overwrite=True), True
        return checkpointed(spark, lambda: df, state, overwrite=True), True
    except Py4JJavaError as error:
        logging.getLogger(__name__).warning("no checkpoint of %s: %s", step.name, error.java_exception)
    except PySparkException as error:
        logging.getLogger(__name__).warning("no checkpoint of %s: %s", step.name, error)
    return df, False


def run(spark: SparkSession, edges: Callable[[], DataFrame], inputs: object, steps: Sequence[Step], folder: str, overwrite: bool = False) -> DataFrame:
    """Apply the steps. A checkpoint is named after the operators so far, their parameters and the inputs,
    so a change of any of them never meets an old state; the last state that is there is where to start.
    overwrite makes all of them anew. Rows are counted by the run that writes a state; steps that must keep them all are held against the state before.
    """
    states = [f"{folder}/{s.name}-{fingerprint([x.name for x in steps[: k + 1]], [x.parameters for x in steps[: k + 1]], inputs)}" for k, s in enumerate(steps)]
    start = 0 if overwrite else max((k + 1 for k, s in enumerate(steps) if s.checkpoint and _there(spark, s, states[k])), default=0)
    df = _load(spark, steps[start - 1], states[start - 1]) if start else edges()
    # rows of df, where the run that wrote its state has told, or the state's footers do
    rows = df.count() if start and any(s.checkpoint and not s.reductive for s in steps[start:]) else None
    for step, state in list(zip(steps, states, strict=True))[start:]:
        after = check_columns(df, step.apply(df), set(step.dropped), set(step.added))
        if step.reductive:
            rows = None
        elif step.checkpoint and rows is None:
            rows = df.count()
        if step.checkpoint:
            seen = Observation()
            after, stored = _save(spark, step, after.observe(seen, F.count("*").alias("n")), state)
            if stored:
                found = seen.get["n"]
                if rows is not None and found != rows:
                    raise ValueError(f"{step.name} must keep all rows")
                rows = found
        df = after
    return df
