"""Slowly-changing history ("check" strategy) without a table format.

Three entry points:

* ``history_from_snapshots`` rebuilds the whole history from a keyed sequence of
  snapshots (one shuffle on the key, windows over each key's dates).
* ``scd2_check`` applies one new snapshot to an existing history: open versions
  are full-outer joined with the incoming rows on the key, changed rows close
  their version and open a new one.  Plain Parquet has no MERGE, so the result
  is written to a new location and then swapped in (``write_versioned``).

Version columns follow the snapshot convention: ``dbt_updated_at``,
``dbt_valid_from``, ``dbt_valid_to`` (NULL = current version).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.session import scratch_path
from subledger.sinks.versions import complete_versions, expire_versions, path_exists, read_current, write_versioned

VALID_FROM, VALID_TO, UPDATED_AT = "dbt_valid_from", "dbt_valid_to", "dbt_updated_at"


def _unchanged(a_cols: Sequence[Column], b_cols: Sequence[Column]) -> Column:
    cond = F.lit(True)
    for a, b in zip(a_cols, b_cols):
        cond = cond & a.eqNullSafe(b)
    return cond


def history_from_snapshots(snapshots: DataFrame, key: str, check_cols: Sequence[str],
                           updated_at: str) -> DataFrame:
    """Versions of each key over a sequence of snapshots (one row per key and time)."""
    w = Window.partitionBy(key).orderBy(updated_at)
    prev = [F.lag(c).over(w) for c in check_cols]
    first = F.row_number().over(w) == 1
    marked = snapshots.withColumn(
        "__new", first | ~_unchanged([F.col(c) for c in check_cols], prev))
    versions = marked.where("__new").drop("__new")
    return versions.withColumns({
        UPDATED_AT: F.col(updated_at),
        VALID_FROM: F.col(updated_at),
        VALID_TO: F.lead(updated_at).over(w),
    })


def scd2_check(history: DataFrame, incoming: DataFrame, key: str, check_cols: Sequence[str],
               updated_at: str) -> DataFrame:
    """Apply one snapshot (``incoming``: one row per key) to ``history``.

    * unchanged key: the open version stays open
    * changed key: the open version closes at the new ``updated_at``, a new one opens
    * new key: a version opens
    * key missing from the snapshot: its open version stays open
    Re-applying the same snapshot changes nothing.
    """
    data_cols = [c for c in incoming.columns]
    closed = history.where(F.col(VALID_TO).isNotNull())
    open_ = history.where(F.col(VALID_TO).isNull())
    # markers tell the sides apart, so a NULL key is a key like any other
    open_ = open_.withColumn("__open", F.lit(True))
    inc = incoming.select(*[F.col(c).alias(f"__in_{c}") for c in data_cols], F.lit(True).alias("__in"))
    j = open_.join(inc, open_[key].eqNullSafe(inc[f"__in_{key}"]), "full_outer")
    has_open, has_in = F.col("__open").isNotNull(), F.col("__in").isNotNull()
    same = _unchanged([F.col(c) for c in check_cols], [F.col(f"__in_{c}") for c in check_cols])
    changed = has_open & has_in & ~same

    kept = j.where(has_open).select(
        *[F.col(c) for c in data_cols], F.col(UPDATED_AT), F.col(VALID_FROM),
        F.when(changed, F.col(f"__in_{updated_at}").cast(history.schema[VALID_TO].dataType))
         .otherwise(F.col(VALID_TO)).alias(VALID_TO))
    opened = j.where((has_in & ~has_open) | changed).select(
        *[F.col(f"__in_{c}").alias(c) for c in data_cols],
        F.col(f"__in_{updated_at}").alias(UPDATED_AT),
        F.col(f"__in_{updated_at}").alias(VALID_FROM),
        F.lit(None).cast(history.schema[VALID_TO].dataType).alias(VALID_TO))
    return closed.unionByName(kept).unionByName(opened)


def initial_history(incoming: DataFrame, updated_at: str, valid_to_type: str = "date") -> DataFrame:
    """First run of a snapshot: every row opens a version."""
    return incoming.withColumns({UPDATED_AT: F.col(updated_at), VALID_FROM: F.col(updated_at),
                                 VALID_TO: F.lit(None).cast(valid_to_type)})


# --------------------------------------------------------------- copy on write
#: Open versions are kept in this many buckets of the key unless the caller says otherwise.
BUCKETS = 64
_BUCKET, _RUN = "key_bucket", "run"


def _changes(open_: DataFrame, incoming: DataFrame, key: str, check_cols: Sequence[str]) -> DataFrame:
    """Incoming rows that open a version: ``__was`` is the key's open version, NULL for a new key."""
    data = incoming.columns
    was = open_.select(F.struct(*open_.columns).alias("__was"))
    now = incoming.select(F.struct(*data).alias("__now"))
    same = _unchanged([F.col(f"__was.{c}") for c in check_cols], [F.col(f"__now.{c}") for c in check_cols])
    joined = now.join(was, F.col(f"__now.{key}").eqNullSafe(F.col(f"__was.{key}")), "left")
    return joined.where(F.col("__was").isNull() | ~same)


class BucketedHistory:
    """An SCD2 table whose merge rewrites only the key buckets that a snapshot changes.

    ``open/run=<n>/key_bucket=<b>`` holds the open versions of the keys of bucket ``b`` as run ``n`` left them, ``closed/run=<n>`` the
    versions that run ``n`` closed (never touched again), and ``manifest`` (version folders) says which run's folder holds
    each bucket and up to which run closed versions count.  The manifest is written last: a run that dies
    before leaves files that nothing reads.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, check_cols: Sequence[str], updated_at: str,
                 buckets: int = BUCKETS):
        self.spark, self.root, self.key, self.check_cols, self.updated_at = spark, root, key, list(check_cols), updated_at
        self.manifest_root = os.path.join(root, "manifest")
        done = complete_versions(spark, self.manifest_root)
        self.run = done[-1] if done else 0
        #: bucket -> run whose folder holds it; at most as many entries as buckets
        self.places = {r[_BUCKET]: r[_RUN] for r in read_current(spark, self.manifest_root).collect()} if done else {}
        self.buckets = self.places.pop(-1) if done else buckets

    def _bucket_of(self, key) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _folders(self, buckets) -> list[str]:
        return [os.path.join(self.root, "open", f"{_RUN}={self.places[b]}", f"{_BUCKET}={b}") for b in sorted(buckets)]

    def _schema(self, data: DataFrame) -> T.StructType:
        day = data.schema[self.updated_at].dataType
        return T.StructType([*data.schema.fields, *(T.StructField(c, day) for c in (UPDATED_AT, VALID_FROM, VALID_TO))])

    def open_versions(self, like: DataFrame, buckets=None) -> DataFrame:
        """Open versions, of some buckets or of all."""
        schema = self._schema(like)
        folders = self._folders(self.places if buckets is None else [b for b in buckets if b in self.places])
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def closed_versions(self, like: DataFrame) -> DataFrame:
        schema = self._schema(like)
        folders = [os.path.join(self.root, "closed", f"{_RUN}={n}") for n in range(1, self.run + 1)]
        folders = [f for f in folders if path_exists(self.spark, os.path.join(f, "_SUCCESS"))]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read(self, like: DataFrame) -> DataFrame:
        """All versions; ``like`` has the columns of a snapshot."""
        return self.closed_versions(like).unionByName(self.open_versions(like))

    def merge(self, incoming: DataFrame) -> list[int]:
        """Apply one snapshot (one row per key); returns the buckets that were rewritten.  The same snapshot again rewrites none."""
        run = self.run + 1
        place = scratch_path(self.spark, f"history/changes-{uuid.uuid4().hex}")
        (_changes(self.open_versions(incoming), incoming, self.key, self.check_cols)
            .withColumn(_BUCKET, self._bucket_of(F.col(f"__now.{self.key}"))).write.parquet(place))
        changes = self.spark.read.parquet(place)
        touched = sorted(r[0] for r in changes.select(_BUCKET).distinct().collect())   # at most one per bucket
        if not touched:
            return []
        data, stamp = incoming.columns, F.col(f"__now.{self.updated_at}")
        never = F.lit(None).cast(incoming.schema[self.updated_at].dataType)
        closed = changes.where(F.col("__was").isNotNull()).select(
            *[F.col(f"__was.{c}").alias(c) for c in [*data, UPDATED_AT, VALID_FROM]], stamp.alias(VALID_TO))
        closed.write.mode("overwrite").parquet(os.path.join(self.root, "closed", f"{_RUN}={run}"))
        opened = changes.select(*[F.col(f"__now.{c}").alias(c) for c in data], stamp.alias(UPDATED_AT), stamp.alias(VALID_FROM),
                                never.alias(VALID_TO), _BUCKET)
        stays = self.open_versions(incoming, touched).withColumn(_BUCKET, self._bucket_of(F.col(self.key)))
        replaced = changes.where(F.col("__was").isNotNull()).select(F.col(f"__was.{self.key}").alias("__key"))
        stays = stays.join(replaced, F.col(self.key).eqNullSafe(F.col("__key")), "left_anti")
        (stays.unionByName(opened).hint("rebalance", F.col(_BUCKET)).write.mode("overwrite").partitionBy(_BUCKET)
            .parquet(os.path.join(self.root, "open", f"{_RUN}={run}")))
        self.places |= {b: run for b in touched}
        rows = [*self.places.items(), (-1, self.buckets)]
        write_versioned(self.spark.createDataFrame(rows, f"{_BUCKET} int, {_RUN} int").coalesce(1), self.manifest_root, run)
        expire_versions(self.spark, self.manifest_root)
        self.run = run
        return touched
