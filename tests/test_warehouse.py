"""Stored tables: versions, views, day refresh with pruning, key-bucket history, post state, co-located joins, footer statistics."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from subledger.operators.quality import ModelChecks
from subledger.plans import posts, revenue
from subledger.plans.build import data_checks
from subledger.plans.catalog import Models, Sources
from subledger.sinks import colocated
from subledger.sinks.history import VALID_FROM, VALID_TO, BucketedHistory, initial_history, scd2_check
from subledger.sinks.tables import publish_view, read_days, read_table, read_view, refresh_touched, touched_rows, write_days, write_full
from subledger.sinks.versions import complete_versions
from subledger.sources.statistics import file_extremes, newest_day

SF = "/root/testdata/sf0.001"
DAY = dt.date(2024, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files(path):
    """Data files under a folder with their times of change."""
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def same(a, b):
    cols = sorted(a.columns)
    return sorted(map(str, a.select(*cols).collect())) == sorted(map(str, b.select(*cols).collect()))


# -- versions and views ----------------------------------------------------------------------------------------

def test_a_rebuild_that_stops_anywhere_leaves_a_table(spark, scratch):
    path = os.path.join(scratch, "t")
    write_full(spark.createDataFrame([(1,)], "id int"), path)
    held = read_table(spark, path)                       # a reader in the middle of it
    os.makedirs(os.path.join(path, "v=2"))               # stopped while writing: no marker
    open(os.path.join(path, "v=2", "part-0.parquet"), "w").close()
    assert [r.id for r in read_table(spark, path).collect()] == [1]
    write_full(spark.createDataFrame([(2,)], "id int"), path)
    assert complete_versions(spark, path) == [1, 3] and [r.id for r in read_table(spark, path).collect()] == [2]
    assert [r.id for r in held.collect()] == [1]         # the version before is kept for it
    write_full(spark.createDataFrame([(3,)], "id int"), path)
    assert complete_versions(spark, path) == [3, 4] and sorted(os.listdir(path)) == ["v=3", "v=4"]


def test_a_view_is_read_by_a_later_session_over_newer_tables(spark, scratch):
    write_full(spark.createDataFrame([(1, "a")], "id int, v string"), os.path.join(scratch, "mart", "t"))
    publish_view(spark, scratch, "upper", "SELECT id, upper(v) AS v FROM {rows} WHERE id > 0", {"rows": "mart/t"})
    write_full(spark.createDataFrame([(2, "b"), (-1, "c")], "id int, v string"), os.path.join(scratch, "mart", "t"))
    later = spark.newSession()
    assert [tuple(r) for r in read_view(later, scratch, "upper").collect()] == [(2, "B")]
    assert not [t for t in later.catalog.listTables() if t.name == "upper"]


# -- day refresh -----------------------------------------------------------------------------------------------

def _days(spark, days, value, n=3):
    return spark.createDataFrame([(DAY + dt.timedelta(days=d), i, value) for d in days for i in range(n)],
                                 "snapshot_date date, id int, v string")


def test_touched_days_are_pruned_at_run_time_and_replaced_exactly(spark, scratch):
    upstream, target = os.path.join(scratch, "up"), os.path.join(scratch, "t")
    write_days(_days(spark, range(20), "old"), upstream)
    write_days(read_days(spark, upstream), target)
    write_days(_days(spark, [4, 7], "new", 5), upstream)
    changes = spark.createDataFrame([(DAY + dt.timedelta(days=4),), (DAY + dt.timedelta(days=7),), (DAY + dt.timedelta(days=4),)],
                                    "snapshot_date date")
    plan = plan_of(touched_rows(read_days(spark, upstream), changes, earliest=DAY))
    assert "dynamicpruning" in plan and "PartitionFilters" in plan
    before = files(target)
    refresh_touched(read_days(spark, upstream), changes, target, lambda d: d.withColumn("v", F.upper("v")), earliest=DAY)
    after = files(target)
    touched = ("snapshot_date=2024-01-05", "snapshot_date=2024-01-08")
    rest = lambda found: {f: t for f, t in found.items() if not any(day in f for day in touched)}
    assert rest(before) == rest(after) and len(rest(after)) < len(after)
    got = {(r.snapshot_date, r.v): r.n for r in read_days(spark, target).groupBy("snapshot_date", "v").agg(F.count("*").alias("n")).collect()}
    assert got == {(DAY + dt.timedelta(days=d), "NEW" if d in (4, 7) else "old"): 5 if d in (4, 7) else 3 for d in range(20)}


def test_one_days_rows_go_to_tasks_by_size(spark, scratch):
    path = os.path.join(scratch, "t")
    write_days(_days(spark, range(3), "x", 50).repartition(16), path)
    assert len(files(path)) == 3


# -- history by key bucket -------------------------------------------------------------------------------------

SNAP = "k string, v string, extra int, d date"


def _snapshots(seed, n=5):
    rng, out, state = random.Random(seed), [], {}
    for day in range(n):
        for k in [None, *"abcdefghijkl"]:
            if rng.random() < 0.4:
                state[k] = rng.choice([None, "x", "y"])
            if rng.random() < 0.1:
                state.pop(k, None)
        out.append([(k, v, rng.randint(0, 9), DAY + dt.timedelta(days=day)) for k, v in state.items()])
    return out


@pytest.mark.parametrize("buckets", [1, 4, 64])
def test_bucketed_history_equals_the_whole_merge(spark, scratch, buckets):
    plain = None
    for rows in _snapshots(buckets):
        snapshot = spark.createDataFrame(rows, SNAP)
        BucketedHistory(spark, scratch, "k", ["v"], "d", buckets).merge(snapshot)
        plain = initial_history(snapshot, "d") if plain is None else scd2_check(plain, snapshot, "k", ["v"], "d")
        plain = spark.createDataFrame(plain.collect(), plain.schema)
    columns = ["k", "v", VALID_FROM, VALID_TO]
    got = BucketedHistory(spark, scratch, "k", ["v"], "d").read(snapshot)
    assert same(got.select(*columns), plain.select(*columns))


def test_a_merge_rewrites_only_what_changed(spark, scratch):
    def history():
        return BucketedHistory(spark, scratch, "k", ["v"], "d", 8)
    first = spark.createDataFrame([(k, "x", 1, DAY) for k in "abcdefghijkl"], SNAP)
    touched = history().merge(first)
    assert len(touched) > 2 and history().merge(first) == [] and history().run == 1
    second = spark.createDataFrame([(k, "y" if k == "c" else "x", 2, DAY + dt.timedelta(days=1)) for k in "abcdefghijkl"], SNAP)
    before = files(scratch)
    assert len(history().merge(second)) == 1
    third = spark.createDataFrame([("zz", "n", 3, DAY + dt.timedelta(days=2))], SNAP)
    middle = files(scratch)
    # a run that dies before its manifest leaves files that nothing reads
    first.write.parquet(os.path.join(scratch, "open", "run=3", "key_bucket=0"))
    assert history().read(first).count() == 13
    history().merge(third)
    after = files(scratch)
    data = lambda found: {f: t for f, t in found.items() if "manifest" not in f}
    assert data(before).items() <= data(middle).items() and data(middle).items() <= data(after).items()
    rows = sorted((r.k, r.v, r[VALID_FROM], r[VALID_TO]) for r in history().read(first).collect() if r.k in ("c", "zz"))
    one, two, three = (DAY + dt.timedelta(days=i) for i in range(3))
    assert rows == [("c", "x", one, two), ("c", "y", two, None), ("zz", "n", three, None)]


# -- post state ------------------------------------------------------------------------------------------------

def test_post_states_merge_in_any_order(spark):
    landing = Sources.from_driver_tables(spark, SF).post_overview
    whole = posts.int_post_overview(posts.post_state(landing))
    third = F.pmod(F.dayofmonth("snapshot_date"), F.lit(3))
    parts = [posts.post_state(landing.where(third == i)) for i in (2, 0, 1)]
    merged = posts.merge_post_states(posts.merge_post_states(parts[0], parts[1]), parts[2])
    assert same(posts.int_post_overview(merged), whole)
    again = posts.merge_post_states(merged, parts[1])
    assert same(posts.int_post_overview(again), whole)


def test_latest_posts_take_one_scan_and_one_shuffle(spark):
    m = Models(Sources.from_driver_tables(spark, SF))
    from subledger.plans import reports
    for df in (m.int_post_overview, reports.top_posts_by_open_rate(m.int_post_overview, "pub_a", dt.date(2024, 2, 1))):
        logical = df._jdf.queryExecution().optimizedPlan().toString()
        assert logical.count("Relation [") == 1 and "Join" not in logical
    few = reports.top_posts_by_open_rate(m.int_post_overview, "pub_a", dt.date(2024, 2, 1))
    aggregate = [x for x in few._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [" in x]
    assert len(aggregate) == 1 and "max_by" in aggregate[0] and "restacks" not in aggregate[0]


# -- co-located joins ------------------------------------------------------------------------------------------

def test_charge_chain_without_an_exchange(spark, scratch):
    m = Models(Sources.from_driver_tables(spark, SF))
    parts = revenue.charge_chain_parts(m.stg_charges, m.stg_invoices, m.current_subscriptions)
    joined = revenue.charge_chain(colocated.write_colocated(spark, parts, "subscription_id", scratch, 4, "test_chain_"))
    assert "Exchange" not in plan_of(joined) and plan_of(joined).count("SortMergeJoin") == 2
    joined.collect()
    assert "Exchange" not in plan_of(joined)
    ch, inv, subs = m.stg_charges, m.stg_invoices, m.current_subscriptions
    plain = ch.join(inv.select("invoice_id", "subscription_id", "period_start"), "invoice_id").join(
        subs.select("subscription_id", F.col("customer_id").alias("cust"), "billing_interval"), "subscription_id").select(
        "charge_id", "invoice_id", "subscription_id", F.col("cust").alias("customer_id"), "billing_interval", "period_start",
        "charged_at", "net_amount_usd")
    assert same(joined, plain)
    for name in parts:
        spark.sql(f"DROP TABLE test_chain_{name}")


def test_a_hot_key_is_dealt_over_slices(spark, scratch):
    """A third of all rows on one subscription: several buckets hold it, and the join still finds every row."""
    charges = spark.range(6000).select(F.col("id").alias("charge_id"), (F.col("id") % 2000).alias("invoice_id"),
                                       F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1500 + 10).alias("subscription_id"))
    invoices = charges.select("invoice_id", "subscription_id").distinct()
    subs = spark.range(1600).select(F.col("id").alias("subscription_id"), (F.col("id") * 2).alias("customer_id"))
    tables = colocated.write_colocated(spark, {"c": colocated.Part(charges, "invoice_id"), "i": colocated.Part(invoices, "invoice_id"),
                                               "s": colocated.Part(subs)}, "subscription_id", scratch, 8, "test_hot_")
    slices = {r.subscription_id: r.n for r in tables["c"].groupBy("subscription_id").agg(F.count_distinct("key_slice").alias("n")).collect()}
    assert slices.pop(7) > 8 and set(slices.values()) == {1}
    per_task = tables["c"].where("subscription_id = 7").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task < 1200        # of 2000
    joined = colocated.colocated_join(colocated.colocated_join(tables["c"], tables["i"], "subscription_id", "invoice_id"),
                                      tables["s"], "subscription_id")
    assert joined.count() == 6000 and joined.where("customer_id <> 2 * subscription_id").count() == 0
    for name in "cis":
        spark.sql(f"DROP TABLE test_hot_{name}")


# -- footers and checks ----------------------------------------------------------------------------------------

def test_extremes_come_from_footers(spark, scratch):
    path = os.path.join(scratch, "t")
    rows = _days(spark, range(9), "x").withColumn("part", F.when(F.col("id") == 0, "a").otherwise("b"))
    rows.write.partitionBy("part").parquet(path)
    found = file_extremes(spark, path, "snapshot_date", ["part"])
    plan = plan_of(found)
    assert "PushedAggregation: [MIN(snapshot_date), MAX(snapshot_date), COUNT(*)]" in plan and "PushedGroupBy: [part]" in plan
    assert sorted(map(tuple, found.collect())) == [("a", DAY, DAY + dt.timedelta(days=8), 9), ("b", DAY, DAY + dt.timedelta(days=8), 18)]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != "avro,csv,json,kafka,orc,text"
    plain = os.path.join(scratch, "plain")
    rows.write.parquet(plain)
    assert newest_day(spark.read.parquet(plain), "snapshot_date") == DAY + dt.timedelta(days=8)
    assert newest_day(rows, "snapshot_date") == DAY + dt.timedelta(days=8)
    stamped = rows.withColumn("snapshot_date", F.col("snapshot_date").cast("timestamp_ntz"))
    assert newest_day(stamped, "snapshot_date") == DAY + dt.timedelta(days=8)
    assert newest_day(rows.where("false"), "snapshot_date") is None


def test_checks_are_counted_by_the_write(spark, scratch):
    """One job writes the rows and counts the failures; nothing but the key column is read for uniqueness."""
    df = spark.range(100).select(F.when(F.col("id") % 10 != 0, F.col("id") % 45).alias("k"), F.lit("z").alias("v"))
    seen, metrics = ModelChecks("t", ("k",), accepted={"v": ("a",)}).observed(df)
    write_full(seen, os.path.join(scratch, "t"))
    assert (metrics.get["rows"], metrics.get["m0"], metrics.get["m1"]) == (100, 10, 100)


def test_declared_checks_read_no_model_again(spark, scratch, monkeypatch):
    """The models are written once each; the report comes from those writes."""
    from subledger.plans import build
    written = []
    monkeypatch.setattr(build, "write_full", lambda df, path, *a: (written.append(path), write_full(df, path, *a))[1])
    rows = data_checks(spark, Sources.from_driver_tables(spark, SF), scratch, dt.date(2024, 1, 31), dt.date(2001, 6, 10)).collect()
    assert len(rows) == 62 and len(written) == len(set(written))
    assert {r.model for r in rows if r.check == "freshness"} == {
        "subscribers_snapshot", "post_overview", "post_traffic", "post_growth", "post_comments"}
