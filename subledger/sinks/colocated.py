"""Tables stored so that their joins need no exchange.

Tables that are joined along one chain of keys (charge -> invoice -> subscription) are bucketed alike by the key at its end, which
every row carries, and a slice number.  All rows of a key and slice are then in one bucket of each table; joins on
``(key, slice, ...)`` merge bucket with bucket.

A key of more than ``1 / (4 * buckets)`` of all rows is hot; there are fewer than ``4 * buckets`` of these.  Its rows are dealt over
``SLICES`` slices by the id that they are joined on, so that rows which belong together meet, and the one row of the key itself is
stored once per slice.  Other keys have slice 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.operators.joins import bounded_broadcast

SLICE = "key_slice"
SLICES = 16
BUCKETS = 32


@dataclass(frozen=True)
class Part:
    """One table of the chain: its rows, and the id by which a hot key's rows are dealt (None: one row per key, stored in every slice)."""

    df: DataFrame
    dealt_by: str | None = None


def hot_keys(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Keys of more than their share of the rows: fewer than ``4 * buckets``."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n"))
    total = df.agg(F.count("*").alias("__total"))
    rows, = total.first()
    return counts.where(F.col("__n") * (4 * buckets) > F.lit(rows)).select(F.col(key).alias("__hot"))


def _sliced(part: Part, key: str, hot: DataFrame) -> DataFrame:
    marked = part.df.join(bounded_broadcast(hot, "fewer than 4 * buckets hot keys"), F.col(key) == F.col("__hot"), "left")
    is_hot = F.col("__hot").isNotNull()
    if part.dealt_by is None:
        slices: Column = F.explode(F.sequence(F.lit(0), F.when(is_hot, SLICES - 1).otherwise(0)))
    else:
        slices = F.when(is_hot, F.pmod(F.xxhash64(part.dealt_by), F.lit(SLICES)).cast("int")).otherwise(F.lit(0))
    return marked.withColumn(SLICE, slices).drop("__hot")


def write_colocated(spark: SparkSession, parts: dict[str, Part], key: str, location: str, buckets: int = BUCKETS,
                    prefix: str = "") -> dict[str, DataFrame]:
    """Write every part as the catalog table ``<prefix><name>`` under ``location``, bucketed alike, and read them back.

    Rows with a NULL key match nothing and are not stored.  The largest part decides which keys are hot; it comes first.
    """
    first = next(iter(parts.values()))
    hot = spark.createDataFrame(hot_keys(first.df, key, buckets).collect(), f"__hot {dict(first.df.dtypes)[key]}")
    out = {}
    for name, part in parts.items():
        rows = _sliced(Part(part.df.where(F.col(key).isNotNull()), part.dealt_by), key, hot)
        (rows.repartition(buckets, key, SLICE).write.mode("overwrite").bucketBy(buckets, key, SLICE).sortBy(key, SLICE)
             .option("path", f"{location}/{name}").saveAsTable(f"{prefix}{name}"))
        out[name] = spark.table(f"{prefix}{name}")
    return out


def colocated_join(left: DataFrame, right: DataFrame, key: str, on: str | None = None) -> DataFrame:
    """Inner join of two parts, bucket with bucket, on the key and its slice (and on ``on``)."""
    keys = [key, SLICE] + ([on] if on else [])
    return left.join(right.hint("merge"), keys, "inner")
