"""As-of lookup and mergeable distinct counts against brute force, with hot keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from subledger.operators import asof, distinct
from subledger.plans import projections
from subledger.plans.catalog import Models, Sources

SF = "/root/testdata/sf0.001"
DAY = dt.date(2015, 1, 1)


def _plain(left, right):
    out = []
    for i, k, d in left:
        best = max(((t, o, v) for rk, t, o, v in right
                    if None not in (rk, t, k, d) and rk == k and t <= d), default=None)
        if best:
            out.append((i, k, d, *best))
    return sorted(out)


def _rows(seed, keys, n_left, n_right):
    rng = random.Random(seed)
    day = lambda: rng.choice([None, *(DAY + dt.timedelta(days=rng.randint(0, 900)) for _ in range(30))])
    key = lambda: rng.choice([None, *range(keys)])
    return ([(i, key(), day()) for i in range(n_left)], [(key(), day(), i, f"v{i}") for i in range(n_right)])


@pytest.mark.parametrize("stretch", [1, 7, 100, 100000])
@pytest.mark.parametrize("one_per_key", [False, True])
def test_latest_at_or_before(spark, stretch, one_per_key):
    left, right = _rows(stretch, 20, 120, 300)
    if one_per_key:
        left = list({k: (i, k, d) for i, k, d in left}.values())
    got = asof.latest_at_or_before(spark.createDataFrame(left, "i int, k int, d date"),
                                   spark.createDataFrame(right, "k int, t date, o int, v string"), "k", "d", "t", ["o"],
                                   one_per_key=one_per_key, stretch_days=stretch)
    assert got.columns == ["i", "k", "d", "t", "o", "v"]
    assert sorted(map(tuple, got.collect())) == _plain(left, right)


def test_latest_at_or_before_of_nothing(spark):
    left, right = spark.createDataFrame([(1, DAY)], "k int, d date"), spark.createDataFrame([(1, DAY, 2)], "k int, t date, v int")
    assert asof.latest_at_or_before(left.limit(0), right, "k", "d", "t").count() == 0
    assert asof.latest_at_or_before(left, right.limit(0), "k", "d", "t").count() == 0
    assert asof.latest_at_or_before(left, right, "k", "d", "t").collect()[0].v == 2


def test_hot_key_is_cut_into_stretches(spark):
    """A third of all rows on one key: no window task gets more of it than the days of a stretch."""
    hot = spark.range(60000).select(F.lit(0).alias("k"), F.date_add(F.lit(DAY), (F.col("id") % 3000).cast("int")).alias("t"),
                                    F.col("id").alias("v"))
    rest = spark.range(120000).select((1 + F.col("id") % 5000).cast("int").alias("k"), F.lit(DAY).alias("t"), F.col("id").alias("v"))
    left = spark.createDataFrame([(0, DAY + dt.timedelta(days=2999)), (1, DAY)], "k int, d date")
    got = asof.latest_at_or_before(left, hot.unionByName(rest), "k", "d", "t", ["v"], one_per_key=True, stretch_days=64)
    assert {r.k: r.v for r in got.collect()} == {0: 59999, 1: 115000}
    newest = hot.groupBy("k", "t").agg(F.max("v")).groupBy(F.floor(F.unix_date("t") / 64)).count()
    assert newest.agg(F.max("count")).first()[0] <= 64
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan, "rows that are one per key need no join at all"
    for part in ("hashpartitioning(__key#", "__stretch#"):
        assert part in plan


def test_churn_has_no_range_join_and_survives_a_hot_subscription(spark):
    m = Models(Sources.from_driver_tables(spark, SF))
    subs, accrual = m.current_subscriptions, m.subscriber_accrual
    target = subs.where(F.col("canceled_at").isNotNull() & (F.to_date("canceled_at") != F.to_date("subscription_created_at"))).join(
        accrual.select("subscription_id").distinct(), "subscription_id").agg(F.min("subscription_id")).first()[0]
    hot = accrual.withColumn("subscription_id", F.when(F.col("charge_id") % 3 == 0, F.lit(target)).otherwise(F.col("subscription_id")))
    assert hot.where(F.col("subscription_id") == target).count() * 4 > hot.count()
    got = projections.churn_last_accrual(subs, hot)
    ended = subs.where("canceled_at is not null and to_date(canceled_at) <> to_date(subscription_created_at)").select(
        "subscription_id", F.to_date("canceled_at").alias("day"))
    order = Window.partitionBy("subscription_id").orderBy(F.desc("reporting_month_end"), F.desc("charge_id"), F.desc("month_offset"))
    plain = (ended.join(hot, "subscription_id").where("reporting_month_start <= day and revenue_type = 'subscriber'")
             .withColumn("n", F.row_number().over(order)).where("n = 1"))
    columns = ["subscription_id", "charge_id", "reporting_month", "recognized_revenue_cents"]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, plain.select(*columns).collect()))
    logical = projections.churn_last_accrual(subs.select("*"), accrual)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in logical.splitlines() if "Join" in line and ("<=" in line or ">=" in line)]


def test_bitmaps_merge_to_exact_counts(spark):
    rng = random.Random(6)
    rows = [(rng.randint(0, 5), rng.choice("ab"), rng.choice([None, *range(10**12, 10**12 + 400)])) for _ in range(5000)]
    df = spark.createDataFrame(rows, "month int, kind string, who long")
    who = df.groupBy("who").agg(F.collect_set(F.struct("month", "kind")).alias("s"))
    numbered = distinct.with_dense_number(who, "who")
    numbers = [r.number for r in numbered.where("who IS NOT NULL").collect()]
    assert len(set(numbers)) == len(numbers) and numbered.where("who IS NULL").first().number is None
    parts = distinct.bitmaps(numbered.select("number", F.inline("s")), ["month", "kind"], "number")
    got = {(r.month, r.kind): r.n for r in distinct.counted(parts, ["month", "kind"], "n").collect()}
    assert got == {(m, k): len({w for a, b, w in rows if (a, b) == (m, k) and w is not None}) for m, k, _ in rows}
    both = distinct.counted(distinct.merged(parts, [F.floor(F.col("month") / 2).alias("pair")]), ["pair"], "n")
    assert {r.pair: r.n for r in both.collect()} == {
        p: len({w for a, _, w in rows if a // 2 == p and w is not None}) for p in range(3)}


def test_month_accrual_spreads_bitmaps_not_customers(spark):
    """One distinct count (charges of a customer and month); the scan of charges appears once."""
    m = Models(Sources.from_driver_tables(spark, SF))
    plan = m.month_accrual._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    spread = next(i for i, line in enumerate(lines) if "Generate explode(sequence" in line)
    assert "bitmap_or_agg" in "".join(lines[:spread]) and "distinct" not in "".join(lines[:spread])
    assert sum("distinct" in line for line in lines) == 1
    one_pass = m.stg_charges._jdf.queryExecution().optimizedPlan().toString()
    # the other scans of orders are those of invoices and subscriptions
    invoices = m.stg_invoices._jdf.queryExecution().optimizedPlan().toString()
    subs = m.current_subscriptions._jdf.queryExecution().optimizedPlan().toString()
    scans = lambda text: sum("Relation" in line and "o_orderkey" in line for line in text.splitlines())
    assert scans(plan) == scans(one_pass) + scans(invoices) + scans(subs)
