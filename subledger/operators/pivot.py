"""Conditional-sum pivots: a fixed category list turned into wide columns.

``sum(CASE WHEN cat = v THEN x END)`` per group: a category absent from a group
yields NULL, not 0.  All measures are computed in one hash aggregate with
map-side partial sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_measures(cat: Column, value: Column, categories: Sequence[tuple[str, str]]) -> list[Column]:
    """One ``sum(when(cat == label, value))`` per ``(output_name, label)``."""
    return [F.sum(F.when(cat == label, value)).alias(name) for name, label in categories]


def pivot_sum(df: DataFrame, keys: Sequence[str], measures: Sequence[Column]) -> DataFrame:
    """Group by ``keys`` and evaluate the pivot ``measures``."""
    return df.groupBy(*keys).agg(*measures)
