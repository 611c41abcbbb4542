"""Latest row per key.

``latest_per_key`` is ``row_number() = 1`` over a window partitioned by the key.
Spark rewrites that filter into a two-phase ``WindowGroupLimit``: each map task
keeps only its own top row per key before the shuffle, so a key holding a third
of all rows ships one row per map task, not a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _desc(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_last()


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, tiebreak: Sequence = ()) -> DataFrame:
    """Keep the row with the greatest ``order`` (then ``tiebreak``) per ``keys``.

    ``order``/``tiebreak`` are columns or names, compared descending with NULLs
    last.  Pass a unique tiebreak to make the choice deterministic.
    """
    w = Window.partitionBy(*keys).orderBy(*[_desc(c) for c in list(order) + list(tiebreak)])
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")
