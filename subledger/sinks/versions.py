"""Version folders: the newest folder with a commit marker is the table.

``base/v=<n>`` holds version ``n``; it counts once Spark's commit protocol has left its marker.  A half-written version is
never read, no pointer can get lost, and there is no moment without a table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

#: Versions kept after a write: the new one, and the one that readers may still be at.
KEPT_VERSIONS = 2


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return hadoop_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path(path))


def all_versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the version folders, finished or not, rising."""
    fs, hadoop_path = _fs(spark, base)
    if not fs.exists(hadoop_path(base)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hadoop_path(base))]
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit())


def complete_versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the versions whose write was committed, rising."""
    return [n for n in all_versions(spark, base) if path_exists(spark, f"{base}/v={n}/_SUCCESS")]


def current_path(spark: SparkSession, base: str) -> str:
    """Location of the newest complete version."""
    versions = complete_versions(spark, base)
    if not versions:
        raise FileNotFoundError(f"no complete version under {base}")
    return os.path.join(base, f"v={versions[-1]}")


def current_version(spark: SparkSession, base: str) -> int:
    return int(current_path(spark, base).rstrip("/").rsplit("v=", 1)[1])


def next_version(spark: SparkSession, base: str) -> int:
    return max(all_versions(spark, base), default=0) + 1


def expire_versions(spark: SparkSession, base: str, keep: int = KEPT_VERSIONS) -> list[int]:
    """Remove the versions before the last ``keep`` complete ones; returns their numbers."""
    kept = complete_versions(spark, base)[-keep:]
    gone = [n for n in all_versions(spark, base) if kept and n < kept[0]]
    fs, hadoop_path = _fs(spark, base)
    for n in gone:
        fs.delete(hadoop_path(f"{base}/v={n}"), True)
    return gone


def write_versioned(df: DataFrame, base: str, version: int, partition_by: str | None = None) -> str:
    """Write ``df`` as ``base/v=<version>``; it is the table from its commit on."""
    target = os.path.join(base, f"v={version}")
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(target)
    return target


def read_current(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(current_path(spark, base))
