"""Invariants of the models over the driver tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from subledger.operators.quality import ModelChecks, check_model
from subledger.plans.catalog import Models, Sources
from subledger.plans.build import data_checks

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def models(spark):
    return Models(Sources.from_driver_tables(spark, ROOT), materialize=True)


def test_annual_spread_sums_to_net(models):
    per_charge = (models.int_charges.where(F.col("billing_interval") == "annual")
                  .groupBy("charge_id").agg(F.count("*").alias("n"),
                                            F.sum("recognized_revenue_cents").alias("spread"),
                                            F.first("net_amount_cents").alias("net")))
    bad = per_charge.where((F.col("n") != 12) | (F.abs(F.col("spread") - F.col("net")) > 6))
    assert per_charge.count() > 0 and bad.count() == 0


def test_monthly_charges_recognised_once(models):
    m = models.int_charges.where(F.col("billing_interval") == "monthly")
    assert m.where((F.col("month_offset") != 0)
                   | (F.col("recognized_revenue_cents") != F.col("net_amount_cents"))).count() == 0


@pytest.mark.parametrize("model,key", [("int_subscriptions", ["subscription_id"]),
                                       ("int_subscribers", ["subscription_id"]),
                                       ("int_post_overview", ["post_id"]),
                                       ("int_post_traffic", ["post_id"]),
                                       ("int_post_growth", ["post_id"]),
                                       ("int_post_comments", ["comment_id"])])
def test_one_row_per_key_after_dedup(models, model, key):
    df = getattr(models, model)
    assert df.groupBy(*key).count().where("count > 1").count() == 0


def test_every_subscriber_row_in_exactly_one_bucket(models):
    daily = models.subscriber_daily()
    buckets = {r[0] for r in daily.select("status_bucket").distinct().collect()}
    assert None not in buckets and buckets <= {"Active", "Cancelled but Active", "Expired", "Non-paid"}
    assert daily.count() == models.int_subscriber_daily.count()


def test_month_accrual_matches_charge_accrual(models):
    by_month = models.month_accrual.groupBy("reporting_month", "revenue_type").agg(
        F.sum("recognized_revenue_cents").alias("a"))
    by_charge = models.charge_accrual.groupBy("reporting_month", "revenue_type").agg(
        F.sum("recognized_revenue_cents").alias("b"))
    j = by_month.join(by_charge, ["reporting_month", "revenue_type"], "full")
    assert j.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_declared_checks(spark, models, scratch):
    """62 checks; the bindings plant payloads without a post, which only the payload's own columns may report."""
    rows = data_checks(spark, Sources.from_driver_tables(spark, ROOT), scratch, dt.date(2024, 1, 31), dt.date(2001, 6, 10)).collect()
    kinds = {k: sum(r.check == k for r in rows) for k in ("not_null", "unique", "accepted_values", "equal", "freshness")}
    assert kinds == {"not_null": 47, "unique": 6, "accepted_values": 3, "equal": 1, "freshness": 5}
    empty = models.src.post_overview.where(F.expr("get_json_object(data, '$.posts[0]') IS NULL")).count()
    payload = {"post_uuid", "title", "is_published", "publication_id", "post_date"}
    failed = {(r.model, r.column): r.failures for r in rows if r.status == "fail"}
    assert empty > 0 and failed == {("stg_post_overview", c): empty for c in payload}


def test_check_model_counts(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", 5), (None, "c", 7), (None, None, 7)], "k int, v string, w int")
    checks, day = ModelChecks("t", ("k", "v", "w"), "k", {"v": ("a", "b")}, (("k", "w"),)), dt.date(2024, 1, 1)
    got = {(r.check, r.column): r.failures for r in check_model(df, checks, day).collect()}
    assert got == {("not_null", "k"): 2, ("not_null", "v"): 1, ("not_null", "w"): 1, ("unique", "k"): 1,
                   ("accepted_values", "v"): 1, ("equal", "k=w"): 4}
    none = check_model(df.where("false"), ModelChecks("t", ("k",), "k", freshness=("v", 10)), day).collect()
    assert [(r.check, r.failures, r.status) for r in none] == [
        ("not_null", 0, "pass"), ("unique", 0, "pass"), ("freshness", None, "warn")]


def test_one_month_equals_the_month_of_all(models):
    labels = [r[0] for r in models.month_accrual.select("reporting_month").distinct().limit(3).collect()]
    for label in [*labels, "March 2000"]:
        whole = models.month_accrual.where(F.col("reporting_month") == label)
        alone = models.month_accrual_of(label).where(F.col("reporting_month") == label)
        assert sorted(map(str, whole.collect())) == sorted(map(str, alone.collect()))


def test_month_plans_leave_out_unread_joins(spark):
    """Recognised revenue reads no subscriber events, and multiplies no rows for its two distinct counts."""
    lazy = Models(Sources.from_driver_tables(spark, ROOT))
    for df in (lazy.month_accrual_of("March 2000"), lazy.month_accrual):
        assert not any(f.endswith("events.parquet") for f in df.inputFiles())
        assert "Expand" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert any(f.endswith("events.parquet") for f in lazy.int_charges.inputFiles())
