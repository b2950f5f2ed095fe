"""Bins of a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def value_bins(value: Column, boundaries: list[float]) -> Column:
    """Index of the last boundary not above value; -1 below the first, null for null.

    A sum of comparisons stays in generated code and needs no sorted search for the usual few boundaries.
    """
    out = F.lit(-1)
    for b in sorted(boundaries):
        out = out + (value >= F.lit(float(b))).cast("int")
    return out
