"""Join patterns of the models.

Equi-joins are left to Catalyst/AQE: a side whose runtime size is under the
broadcast threshold is broadcast, otherwise both sides are hash-partitioned on
the key and AQE splits skewed partitions.  Explicit ``broadcast`` is reserved
for relations whose size has a bound by construction (see ``bounded_broadcast``).

Rows whose join key is NULL can never match, yet on a shuffle join they all hash
to one partition; ``left_join_on`` gives them distinct never-matching keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join_agg(df: DataFrame, many: DataFrame, key: str, aggs: Sequence[Column],
                  many_key: str | None = None) -> DataFrame:
    """Aggregate ``many`` per key first, then left-join it, so ``df`` keeps its grain."""
    many_key = many_key or key
    agg = many.groupBy(F.col(many_key).alias("__k")).agg(*aggs)
    return df.join(agg, df[key] == agg["__k"], "left").drop("__k")


def left_join_on(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column,
                 spread_by: Sequence[str] | None = None) -> DataFrame:
    """Left join on computed keys without funnelling NULL-key rows into one task.

    Both sides join on ``struct(is_null, key)``.  A left row whose key is NULL
    gets ``(true, hash of spread_by)``: it still cannot match (every right key is
    ``(false, key)``), but the hash spreads such rows over all reducers instead
    of one.  The hash is deterministic, so a retried map task routes rows the
    same way.  One pass over ``left``; ``right`` should be unique on its key for
    the left grain to be kept (callers deduplicate first).  ``spread_by`` names the
    row's id; without it the whole row is hashed, which keeps every left column in
    the plan.  Helper columns are dropped.
    """
    key_type = left.select(left_key.alias("k")).schema["k"].dataType
    salt = F.xxhash64(*[F.col(c) for c in spread_by or left.columns]).cast(key_type)
    lk = left.withColumn("__lk", F.struct(left_key.isNull().alias("n"),
                                          F.coalesce(left_key.cast(key_type), salt).alias("k")))
    rk = right.where(right_key.isNotNull()).withColumn(
        "__rk", F.struct(F.lit(False).alias("n"), right_key.cast(key_type).alias("k")))
    return lk.join(rk, lk["__lk"] == rk["__rk"], "left").drop("__lk", "__rk")


def bounded_broadcast(df: DataFrame, bound: str) -> DataFrame:
    """Broadcast a relation whose row count has a stated bound by construction.

    ``bound`` documents the reason (e.g. "one row per billing interval and month")
    and is required so every explicit broadcast in the code carries its proof.
    """
    if not bound:
        raise ValueError("an explicit broadcast needs a size bound")
    return F.broadcast(df)
