"""Partition refresh, SCD2 history and the streaming refresh, on scratch folders."""

import pytest


import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from subledger.sinks.history import VALID_FROM, VALID_TO, BucketedHistory, history_from_snapshots, initial_history, scd2_check
from subledger.sinks.tables import partition_dirs, read_table, refresh_partitions
from subledger.sinks.versions import read_current, write_versioned
from subledger.streaming.incremental import start_refresh_stream


def _daily(spark, days, value):
    rows = [(dt.date(2024, 1, d), i, value) for d in days for i in range(3)]
    return spark.createDataFrame(rows, "snapshot_date date, id int, v string")


def test_refresh_first_run_then_lookback(spark, scratch):
    path = os.path.join(scratch, "daily")
    refresh_partitions(_daily(spark, range(1, 11), "old"), path, dt.date(2024, 1, 10))
    assert len(partition_dirs(path)) == 10
    refresh_partitions(_daily(spark, range(1, 11), "new"), path, dt.date(2024, 1, 10))
    out = spark.read.parquet(path)
    by_day = {r.snapshot_date: r.v for r in out.select("snapshot_date", "v").distinct().collect()}
    assert all(by_day[dt.date(2024, 1, d)] == "old" for d in range(1, 7))
    assert all(by_day[dt.date(2024, 1, d)] == "new" for d in range(7, 11))
    assert out.count() == 30
    # refreshing twice equals refreshing once
    refresh_partitions(_daily(spark, range(1, 11), "new"), path, dt.date(2024, 1, 10))
    assert spark.read.parquet(path).count() == 30


def _snap(spark, rows):
    return spark.createDataFrame(rows, "subscription_id int, cancel_date date, email string, snapshot_date date")


def test_scd2_check_cases(spark, scratch):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    first = _snap(spark, [(1, None, "a", d1), (2, None, "b", d1), (3, d1, "c", d1), (4, None, "d", d1)])
    hist = initial_history(first, "snapshot_date")
    second = _snap(spark, [(1, None, "a2", d2),   # unchanged watched column
                           (2, d2, "b", d2),      # NULL -> value
                           (5, None, "e", d2)])   # new key; 3 and 4 vanish
    h2 = scd2_check(hist, second, "subscription_id", ["cancel_date"], "snapshot_date")
    rows = sorted((r.subscription_id, r[VALID_FROM], r[VALID_TO]) for r in h2.collect())
    assert rows == [(1, d1, None), (2, d1, d2), (2, d2, None), (3, d1, None), (4, d1, None), (5, d2, None)]
    # re-running the same snapshot changes nothing
    h3 = scd2_check(h2, second, "subscription_id", ["cancel_date"], "snapshot_date")
    assert sorted(map(str, h3.collect())) == sorted(map(str, h2.collect()))
    # one open version per key
    assert h3.where(F.col(VALID_TO).isNull()).groupBy("subscription_id").count().where("count > 1").count() == 0
    base = os.path.join(scratch, "history")
    write_versioned(h3, base, 1)
    assert read_current(spark, base).count() == h3.count()


def test_history_from_snapshots(spark):
    d = [dt.date(2024, 1, i) for i in range(1, 5)]
    rows = [(1, None, "x", d[0]), (1, None, "x", d[1]), (1, d[1], "x", d[2]), (1, d[1], "y", d[3]),
            (2, d[0], "z", d[0])]
    h = history_from_snapshots(_snap(spark, rows), "subscription_id", ["cancel_date"], "snapshot_date")
    got = sorted((r.subscription_id, r[VALID_FROM], r[VALID_TO]) for r in h.collect())
    assert got == [(1, d[0], d[2]), (1, d[2], None), (2, d[0], None)]


def test_streaming_refresh_replaces_touched_days(spark, scratch):
    landing, target = os.path.join(scratch, "landing"), os.path.join(scratch, "target")
    schema = "snapshot_date timestamp_ntz, id int, v string"

    def land(day, ids, v):
        rows = [(dt.datetime(2024, 1, day, 6), i, v) for i in ids]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(landing)

    def build(df):
        return df.select(F.to_date("snapshot_date").alias("snapshot_date"), "id", "v")

    name = f"test-{uuid.uuid4().hex}"
    land(1, [1, 2], "a")
    land(2, [1], "a")
    start_refresh_stream(spark, landing, spark.createDataFrame([], schema).schema, target, build, name).awaitTermination()
    assert spark.read.parquet(target).count() == 3
    land(2, [2], "b")             # a late row for day 2: the whole day is recomputed
    start_refresh_stream(spark, landing, spark.createDataFrame([], schema).schema, target, build, name).awaitTermination()
    out = spark.read.parquet(target)
    assert out.count() == 4
    assert out.where("snapshot_date = date'2024-01-02'").count() == 2
    assert out.where("snapshot_date = date'2024-01-01'").count() == 2


def test_build_all_twice(spark, scratch):
    """A full run writes every model; a second run is idempotent for the history."""
    from subledger.plans.build import HISTORY_KEY, HISTORY_STAMP, HISTORY_WATCHED, build_all
    from subledger.plans.catalog import Models, Sources
    from subledger.sinks.tables import read_view
    root = "/root/testdata/sf0.001"
    as_of = dt.date(2024, 1, 31)
    out = build_all(spark, Sources.from_driver_tables(spark, root), scratch, as_of)
    lazy = Models(Sources.from_driver_tables(spark, root))
    for name in ("stg_charges", "int_charges", "int_post_overview"):
        assert read_table(spark, out[name]).count() == getattr(lazy, name).count()
    assert read_table(spark, out["data_checks"]).count() == 62
    assert spark.read.parquet(out["subscriber_daily"]).count() == lazy.int_subscriber_daily.count()
    assert read_view(spark.newSession(), scratch, "subscriber_compat").count() == lazy.int_subscriber_daily.count()

    def history():
        return BucketedHistory(spark, out["subscriber_history"], HISTORY_KEY, HISTORY_WATCHED, HISTORY_STAMP)
    before = history().read(lazy.int_subscribers).count()
    days = partition_dirs(out["subscriber_daily"])
    build_all(spark, Sources.from_driver_tables(spark, root), scratch, as_of)
    assert history().run == 1 and history().read(lazy.int_subscribers).count() == before
    assert partition_dirs(out["subscriber_daily"]) == days
    assert spark.read.parquet(out["subscriber_daily"]).count() == lazy.int_subscriber_daily.count()


def test_failed_rebuild_keeps_the_old_table(spark, scratch):
    from pyspark.sql import functions as F

    from subledger.sinks.tables import write_full
    path = os.path.join(scratch, "full")
    days = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id long, day string")
    write_full(days, path, "day")
    with pytest.raises(Exception):
        write_full(days.withColumn("id", F.raise_error(F.lit("broken")).cast("long")), path, "day")
    assert read_table(spark, path).count() == 2
    write_full(days.where("id = 2"), path, "day")      # a rebuild keeps no old day
    assert [r.id for r in read_table(spark, path).collect()] == [2]


def test_merge_keeps_versions_with_a_null_key(spark):
    from subledger.sinks.history import initial_history, scd2_check
    schema = "k string, v string, d date"
    first = spark.createDataFrame([(None, "a", dt.date(2024, 1, 1)), ("x", "a", dt.date(2024, 1, 1))], schema)
    history = initial_history(first, "d")
    after = scd2_check(history, spark.createDataFrame([("x", "b", dt.date(2024, 1, 2))], schema), "k", ["v"], "d")
    assert sorted((r.k or "", r.v) for r in after.collect()) == [("", "a"), ("x", "a"), ("x", "b")]


def test_unfinished_version_is_not_read(spark, scratch):
    from subledger.sinks.versions import complete_versions
    rows = spark.createDataFrame([(1,)], "id long")
    assert complete_versions(spark, scratch) == []
    write_versioned(rows, scratch, 1)
    os.makedirs(os.path.join(scratch, "v=2"))
    assert complete_versions(spark, scratch) == [1] and read_current(spark, scratch).count() == 1
