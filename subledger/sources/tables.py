"""Scans of named tables.

A table is a directory or file of Parquet under a root folder.  Scans are lazy:
Catalyst prunes the columns a plan never reads and pushes filters into the
Parquet reader, so callers select what they need instead of asking for it here.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Schemas of the driver tables the bindings read.  Declaring them
# skips footer-based schema inference, which on a large table can itself launch
# a distributed job.
DRIVER_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

# The driver test tables (one parquet file each).
DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(root: str, name: str) -> str:
    """``root/name.parquet`` when that file exists, else ``root/name``."""
    candidate = os.path.join(root, f"{name}.parquet")
    if os.path.exists(candidate) or "://" in root:
        return candidate
    return os.path.join(root, name)


def load(spark: SparkSession, root: str, name: str, schema: StructType | str | None = None) -> DataFrame:
    """Scan table ``name`` under ``root``; an explicit schema skips footer inference."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(table_path(root, name))
