"""Exact distinct counts that merge: bitmaps over dense numbers.

A ``count(DISTINCT x)`` of one month says nothing about two months together.  A bitmap does: bitmaps of parts are or-ed, and the
bits counted.  A bitmap of Spark holds the 32,768 numbers of one bucket in 4 KB, so ids must be dense:
``with_dense_number`` numbers the rows of a relation that holds each id once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "__bucket", "__bits"


def with_dense_number(df: DataFrame, key: str, out: str = "number") -> DataFrame:
    """``df`` (one row per ``key``) with a number from 1 that is dense within each partition; NULL for a NULL key.

    Rows are sorted within their partition first, so that a task that is run again numbers them alike.
    """
    return (df.sortWithinPartitions(key)
            .withColumn("__n", F.monotonically_increasing_id() + 1)
            .withColumn(out, F.when(F.col(key).isNotNull(), F.col("__n"))).drop("__n"))


def bitmaps(df: DataFrame, by: Sequence, number: str, *aggs: Column) -> DataFrame:
    """One bitmap per group of ``by`` and bucket of numbers, with further mergeable aggregates."""
    return df.groupBy(*by, F.bitmap_bucket_number(F.col(number)).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(number))).alias(BITS), *aggs)


def merged(parts: DataFrame, by: Sequence, *aggs: Column) -> DataFrame:
    """Bitmaps of the coarser groups ``by``: the union of their parts' numbers."""
    return parts.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS), *aggs)


def counted(parts: DataFrame, by: Sequence[str], out: str, *aggs: Column) -> DataFrame:
    """Numbers in each group of ``by``, whose buckets hold each number once."""
    return parts.groupBy(*by).agg(F.sum(F.bitmap_count(BITS)).alias(out), *aggs)
