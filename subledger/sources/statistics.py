"""Answers from file footers: extremes and counts of stored tables without reading a row.

Spark's DataSource V2 Parquet reader pushes ``min``, ``max`` and ``count`` into the scan, per partition folder where they are grouped by
partition columns.  It does so for integers, floats, dates and booleans; for other types, or under a filter on a data column,
the same plan reads the column.  The reader is chosen by session settings, so the plans live in a session of their own (same
application, same tables): the caller's session stays as it is.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# File sources that stay with the V1 reader; Parquet does not.
_V1_SOURCES = "avro,csv,json,kafka,orc,text"


def statistics_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet scans take aggregates."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", _V1_SOURCES)
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.session.timeZone", "UTC")
    return own


def file_extremes(spark: SparkSession, path: str, column: str, by: Sequence[str] = ()) -> DataFrame:
    """``*by, first, last, row_count`` of the Parquet table at ``path``; ``by`` names partition columns."""
    table = statistics_session(spark).read.parquet(path)
    return table.groupBy(*by).agg(F.min(column).alias("first"), F.max(column).alias("last"), F.count("*").alias("row_count"))


def newest_day(table: DataFrame, column: str) -> dt.date | None:
    """The newest day of a relation: from the footers where it is a plain Parquet table with a date, else from its one column."""
    files = table.inputFiles() if dict(table.dtypes)[column] == "date" and _is_plain_scan(table) else []
    if files:
        return statistics_session(table.sparkSession).read.schema(table.schema).parquet(*files).agg(F.max(column)).first()[0]
    return table.agg(F.to_date(F.max(column))).first()[0]


def _is_plain_scan(table: DataFrame) -> bool:
    return "LogicalRelation" in table._jdf.queryExecution().analyzed().getClass().getSimpleName()
