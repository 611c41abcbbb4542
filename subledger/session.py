"""Spark session conventions shared by every pipeline.

* UTC session time zone: every ``date(ts)`` in the models is a UTC calendar day.
* ANSI mode stays on (Spark 4 default); "safe" casts are spelled ``try_*``.
* AQE with partition coalescing and skew-join splitting: the N:1 joins of the
  models (charge -> invoice -> subscription, e-mail enrichment) are hash joins
  whose many side can carry a hot key; AQE splits such partitions at run time.
* A skewed join is split even where a window follows and another shuffle is the price.
* Generated code beyond 8,000 bytes of one method is never compiled by the JVM; such stages (payloads of dozens of fields) are generated
  expression by expression instead.
* A join may use a partitioning by some of its keys (tables bucketed alike, ``sinks.colocated``).
* Checkpoints go to the shared folder named by ``spark.checkpoint.dir``; a value
  is only supplied when the session has none (local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "subledger") -> SparkSession:
    """Return (or create) a session configured with :data:`SESSION_CONF`.

    On a cluster ``master`` is left to ``spark-submit``; tests pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (idempotent)."""
    for key, value in SESSION_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    return spark


_LOCAL_CHECKPOINT_DIRS: dict[int, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset and
    the session runs in local mode (tests) a scratch folder is created for the
    session; on a cluster an unset value is an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or _LOCAL_CHECKPOINT_DIRS.get(id(sc))
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(a machine-local folder is not visible to other executors)")
        configured = tempfile.mkdtemp(prefix="subledger-ckpt-")
        _LOCAL_CHECKPOINT_DIRS[id(sc)] = configured
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A location for intermediate tables under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), name)
