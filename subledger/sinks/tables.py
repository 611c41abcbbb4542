"""Materialisation of models: full rebuilds, stored views, day-partition refreshes.

* A full rebuild is a new version folder (``sinks.versions``); readers go on with the old one until the new one is committed.
* A view is a stored definition, SQL over tables beside it, resolved on read; any later session can read it.
* A day-partitioned table is refreshed by replacing exactly the day partitions in the result (dynamic partition overwrite): the days
  of a look-back window, or the days that new rows touched.  Its upstream is partitioned by day as well, so a refresh reads those
  folders only: by a literal bound, or by dynamic partition pruning from the touched days.
"""

from __future__ import annotations

import datetime as dt
import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.operators.joins import bounded_broadcast
from subledger.sinks.versions import (complete_versions, expire_versions, next_version, path_exists, read_current,
                                      write_versioned)

DAY_BOUND = "one row per calendar day"


def write_full(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Full rebuild of the table at ``path``: a new version, after whose commit older ones are expired."""
    spark = df.sparkSession
    write_versioned(df, path, next_version(spark, path), partition_by)
    expire_versions(spark, path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed version of a rebuilt table; a folder without versions is read as it is."""
    return read_current(spark, path) if complete_versions(spark, path) else spark.read.parquet(path)


def publish_view(spark: SparkSession, root: str, name: str, sql: str, inputs: dict[str, str]) -> str:
    """Store the view ``name`` beside the tables under ``root``: ``sql`` names each input as ``{input}``, ``inputs`` gives their
    places relative to ``root``.  Nothing of the rows is stored."""
    place = os.path.join(root, "views", name)
    definition = spark.createDataFrame([(sql, json.dumps(inputs))], "sql string, inputs string").coalesce(1)
    write_full(definition, place)
    return place


def read_view(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored view over the tables as they are now."""
    view = read_table(spark, os.path.join(root, "views", name)).first()
    frames = {k: read_table(spark, os.path.join(root, v)) for k, v in json.loads(view.inputs).items()}
    return spark.sql(view.sql, **frames)


def write_days(df: DataFrame, path: str, day_col: str = "snapshot_date") -> None:
    """Replace exactly the day partitions present in ``df``; one day's rows meet in as many tasks as their size asks for."""
    (df.hint("rebalance", F.col(day_col)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(day_col).parquet(path))


def read_days(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    """A day-partitioned table; ``like`` declares the schema, so that no footer is read for it."""
    return (spark.read.schema(like.schema) if like is not None else spark.read).parquet(path)


def refresh_partitions(daily: DataFrame, path: str, as_of: dt.date,
                       part_col: str = "snapshot_date", lookback_days: int = 3,
                       build: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Incremental refresh of a day-partitioned table at ``path``: everything on the first run, later the last ``lookback_days``.

    ``daily`` is the upstream relation; ``build(upstream) -> DataFrame`` turns the
    (possibly filtered) upstream into target rows (identity by default).  Returns
    the rows that were written.
    """
    first_run = not path_exists(daily.sparkSession, path)
    src = daily if first_run else daily.where(
        F.col(part_col) >= F.lit(as_of - dt.timedelta(days=lookback_days)))
    out = build(src) if build else src
    write_days(out, path, part_col)
    return out


def touched_rows(upstream: DataFrame, changes: DataFrame, day_col: str = "snapshot_date", earliest: dt.date = dt.date.min,
                 changed_day: str | None = None) -> DataFrame:
    """Rows of ``upstream`` on the days that ``changes`` touched, from ``earliest`` on.

    The days are a broadcast of one row per calendar day, so over an upstream partitioned by day the scan is
    pruned to their folders at run time.
    """
    day = F.to_date(changed_day or day_col)
    days = changes.select(day.alias(day_col)).where(F.col(day_col) >= F.lit(earliest.isoformat()).cast("date")).distinct()
    return upstream.join(bounded_broadcast(days, DAY_BOUND), day_col, "left_semi")


def refresh_touched(upstream: DataFrame, changes: DataFrame, path: str, build: Callable[[DataFrame], DataFrame],
                    day_col: str = "snapshot_date", earliest: dt.date = dt.date.min) -> DataFrame:
    """Recompute the touched days of the table at ``path`` from ``upstream``; all other days stay as they are."""
    out = build(touched_rows(upstream, changes, day_col, earliest))
    write_days(out, path, day_col)
    return out


def partition_dirs(path: str, part_col: str = "snapshot_date") -> list[str]:
    """Partition values present under a local ``path`` (for tests and inspection)."""
    if not os.path.isdir(path):
        return []
    return sorted(d.split("=", 1)[1] for d in os.listdir(path) if d.startswith(f"{part_col}="))
