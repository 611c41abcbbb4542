"""Revenue projections: closed-month actuals, capped EWMA and the live month.

Scale: the inputs (subscriptions, charge accrual) are large, but every branch
aggregates to at most one row per billing interval and fiscal month before any
window or join.  Those aggregates have a size bound by construction (intervals x
calendar months), so they are broadcast explicitly; the only large shuffles are
the aggregations themselves and the as-of lookup of the churn branch, which is computed once and feeds both churn counts
and churn revenue.

"Today" is the explicit ``as_of`` date; the reporting window is derived from it
on the driver as literals (no one-row cross join).
"""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subledger.functions import fiscal
from subledger.functions.money import round_div, to_major
from subledger.functions.projection import WEIGHTS, ewma_cents, projected_cents
from subledger.operators.asof import latest_at_or_before
from subledger.operators.joins import bounded_broadcast
from subledger.plans.revenue import SUBSCRIBER

MONTH_BOUND = "one row per billing interval and fiscal month"
INTERVAL_BOUND = "one row per billing interval"


@dataclass(frozen=True)
class ReportingWindow:
    """The open fiscal period containing ``as_of``."""

    as_of: dt.date
    month: dt.date
    label: str
    start: dt.date
    end: dt.date
    total_days: int
    elapsed_days: int

    @classmethod
    def of(cls, as_of: dt.date, cut_day: int = fiscal.CUT_DAY) -> "ReportingWindow":
        first = as_of.replace(day=1)
        if as_of.day < cut_day:
            first = (first - dt.timedelta(days=1)).replace(day=1)
        nxt = (first + dt.timedelta(days=32)).replace(day=1)
        start = first + dt.timedelta(days=cut_day - 1)
        end = nxt + dt.timedelta(days=cut_day - 2)
        label = f"{calendar.month_name[first.month]} {first.year}"
        return cls(as_of, first, label, start, end, (end - start).days + 1, (as_of - start).days + 1)


def not_same_day_cancel(created: str = "subscription_created_at", canceled: str = "canceled_at") -> Column:
    return F.col(canceled).isNull() | (F.to_date(canceled) != F.to_date(created))


def closed_actuals(month_accrual: DataFrame, as_of: dt.date) -> DataFrame:
    """Subscriber revenue of fiscal months ended before ``as_of``, numbered per interval."""
    w = Window.partitionBy("billing_interval").orderBy("reporting_month_end")
    a = month_accrual.where((F.col("revenue_type") == SUBSCRIBER)
                            & (F.col("reporting_month_end") < F.lit(as_of)))
    return a.select(
        fiscal.month_label("reporting_month_start").alias("reporting_month"),
        "reporting_month_start", "reporting_month_end", "billing_interval",
        F.col("recognized_revenue_cents").alias("revenue_cents"), "subscriber_count",
        to_major(round_div(F.col("recognized_revenue_cents"), F.col("subscriber_count")))
        .alias("avg_rev_per_sub"),
        F.row_number().over(w).alias("rn"))


def delta_history(actuals: DataFrame, window: ReportingWindow, depth: int = len(WEIGHTS)) -> DataFrame:
    """Closed rows (one per past month with ``depth`` prior deltas) and one live row
    per interval built from the last closed month.  Lags replace offset self-joins."""
    w = Window.partitionBy("billing_interval").orderBy("reporting_month_end")
    d = actuals.withColumn("net_change", F.col("revenue_cents") - F.lag("revenue_cents", 1).over(w))
    d = d.withColumns({
        "prev_revenue": F.lag("revenue_cents", 1).over(w),
        **{f"nc{k}": F.lag("net_change", k).over(w) for k in range(1, depth + 1)},
        "max_rn": F.max("rn").over(Window.partitionBy("billing_interval")),
    })
    closed = d.where(F.col(f"nc{depth}").isNotNull()).select(
        F.col("reporting_month").alias("target_month"),
        F.col("reporting_month_start").alias("target_start"),
        F.col("reporting_month_end").alias("target_end"), "billing_interval",
        F.lit("closed").alias("row_type"), F.col("prev_revenue").alias("prior_cents"),
        *[F.col(f"nc{k}").alias(f"d{k}") for k in range(1, depth + 1)])
    live = d.where((F.col("rn") == F.col("max_rn")) & F.col(f"nc{depth - 1}").isNotNull()).select(
        F.lit(window.label).alias("target_month"), F.lit(window.start).alias("target_start"),
        F.lit(window.end).alias("target_end"), "billing_interval", F.lit("live").alias("row_type"),
        F.col("revenue_cents").alias("prior_cents"), F.col("net_change").alias("d1"),
        *[F.col(f"nc{k - 1}").alias(f"d{k}") for k in range(2, depth + 1)])
    return closed.unionByName(live)


def with_projection(deltas: DataFrame, depth: int = len(WEIGHTS)) -> DataFrame:
    ds = [F.col(f"d{k}") for k in range(1, depth + 1)]
    return deltas.withColumns({"ewma_delta_cents": ewma_cents(ds),
                               "projected_cents": projected_cents(F.col("prior_cents"), ds)})


def historical_starts(subs: DataFrame) -> DataFrame:
    s = subs.where(F.col("subscription_created_at").isNotNull() & not_same_day_cancel())
    return s.groupBy(
        "billing_interval",
        fiscal.month_label(fiscal.fiscal_month("subscription_created_at")).alias("reporting_month"),
    ).agg(F.count_distinct("subscription_id").alias("start_count"))


def churn_last_accrual(subs: DataFrame, accrual: DataFrame) -> DataFrame:
    """Per cancelled subscription, its last subscriber accrual row starting on or before the cancellation day: carried forward along
    the subscription's months, without a range join (computed once for counts and revenue)."""
    s = subs.where(F.col("canceled_at").isNotNull()
                   & (F.to_date("canceled_at") != F.to_date("subscription_created_at"))).select(
        "subscription_id", "billing_interval", F.to_date("canceled_at").alias("cancel_day"))
    ca = accrual.where(F.col("revenue_type") == SUBSCRIBER).select(
        "subscription_id", "reporting_month", "reporting_month_start", "recognized_revenue_cents", "charge_id", "month_offset")
    return latest_at_or_before(s, ca, "subscription_id", "cancel_day", "reporting_month_start", ["charge_id", "month_offset"],
                               one_per_key=True)


def starts_revenue(subs: DataFrame, accrual: DataFrame) -> DataFrame:
    s = subs.where(F.col("subscription_created_at").isNotNull() & not_same_day_cancel()).select(
        F.col("subscription_id").alias("s_subscription_id"),
        fiscal.period_start(fiscal.fiscal_month("subscription_created_at")).alias("start_period"))
    ca = accrual.where(F.col("revenue_type") == SUBSCRIBER)
    j = ca.join(s, (s.s_subscription_id == ca.subscription_id)
                & (ca.reporting_month_start == s.start_period), "inner")
    return j.groupBy("billing_interval", "reporting_month").agg(
        F.sum("recognized_revenue_cents").alias("starts_revenue_cents"))


def live_counters(subs: DataFrame, accrual: DataFrame, window: ReportingWindow):
    start, as_of = F.lit(window.start), F.lit(window.as_of)
    created, canceled = F.to_date("subscription_created_at"), F.to_date("canceled_at")
    ls = subs.where(created.between(start, as_of) & not_same_day_cancel()).groupBy(
        "billing_interval").agg(F.count_distinct("subscription_id").alias("starts_to_date"))
    lc = subs.where(canceled.between(start, as_of) & (canceled != created)).groupBy(
        "billing_interval").agg(F.count_distinct("subscription_id").alias("churn_to_date"))
    lr = accrual.where((F.col("reporting_month_start") == start)
                       & (F.col("revenue_type") == SUBSCRIBER)).groupBy("billing_interval").agg(
        F.sum("recognized_revenue_cents").alias("revenue_to_date_cents"))
    return ls, lc, lr


def _prorate(count: Column, window: ReportingWindow) -> Column:
    """round(count / elapsed * total, 1)"""
    return round_div(count * F.lit(10 * window.total_days), F.lit(window.elapsed_days)) / 10.0


def _pct(num: Column, den: Column) -> Column:
    """round(num / den * 100, 1), NULL when den is 0 or NULL."""
    return round_div(num * 1000, den) / 10.0


def revenue_projections(month_accrual: DataFrame, accrual: DataFrame, subs: DataFrame,
                        as_of: dt.date) -> DataFrame:
    win = ReportingWindow.of(as_of)
    actuals = closed_actuals(month_accrual, as_of)
    re_ = with_projection(delta_history(actuals, win))

    a = bounded_broadcast(actuals.select(
        F.col("reporting_month").alias("a_month"), F.col("billing_interval").alias("a_interval"),
        F.col("revenue_cents").alias("a_revenue"), F.col("subscriber_count").alias("a_subs")), MONTH_BOUND)
    hs = bounded_broadcast(historical_starts(subs).toDF("hs_interval", "hs_month", "start_count"), MONTH_BOUND)
    churned = churn_last_accrual(subs, accrual)
    hc = bounded_broadcast(churned.groupBy("billing_interval", "reporting_month").agg(
        F.count_distinct("subscription_id").alias("churn_count"),
        F.sum("recognized_revenue_cents").alias("churn_revenue_cents"),
    ).toDF("hc_interval", "hc_month", "churn_count", "churn_revenue_cents"), MONTH_BOUND)
    sr = bounded_broadcast(starts_revenue(subs, accrual).toDF("sr_interval", "sr_month", "starts_revenue_cents"),
                           MONTH_BOUND)
    ls, lc, lr = (bounded_broadcast(x, INTERVAL_BOUND) for x in live_counters(subs, accrual, win))
    ls, lc, lr = (ls.withColumnRenamed("billing_interval", "ls_interval"),
                  lc.withColumnRenamed("billing_interval", "lc_interval"),
                  lr.withColumnRenamed("billing_interval", "lr_interval"))

    bi, tm = F.col("billing_interval"), F.col("target_month")
    j = (re_.join(a, (a.a_month == tm) & (a.a_interval == bi), "left")
            .join(hs, (hs.hs_interval == bi) & (hs.hs_month == tm), "left")
            .join(hc, (hc.hc_interval == bi) & (hc.hc_month == tm), "left")
            .join(sr, (sr.sr_interval == bi) & (sr.sr_month == tm), "left")
            .join(ls, ls.ls_interval == bi, "left")
            .join(lc, lc.lc_interval == bi, "left")
            .join(lr, lr.lr_interval == bi, "left"))
    closed, live = F.col("row_type") == "closed", F.col("row_type") == "live"
    proj = F.col("projected_cents")
    out = j.select(
        F.col("target_month").alias("reporting_month"), "target_start", "target_end",
        "billing_interval", "row_type",
        F.when(live, _pct(F.lit(win.elapsed_days), F.lit(win.total_days))).alias("pct_period_elapsed"),
        to_major("prior_cents").alias("recurring_revenue"),
        F.when(closed, F.col("a_subs") - F.col("start_count")).alias("recurring_subscribers"),
        F.when(closed, F.col("start_count")).when(live, F.col("starts_to_date")).alias("starts"),
        F.when(live, _prorate(F.col("starts_to_date"), win)).alias("starts_prorated"),
        F.when(closed, to_major("starts_revenue_cents")).alias("starts_revenue"),
        F.when(closed, F.col("churn_count")).when(live, F.col("churn_to_date")).alias("churn"),
        F.when(live, _prorate(F.col("churn_to_date"), win)).alias("churn_prorated"),
        F.when(closed, to_major("churn_revenue_cents")).alias("churn_revenue"),
        F.when(closed, to_major("a_revenue")).when(live, to_major("revenue_to_date_cents"))
        .alias("actual_revenue"),
        to_major(proj).alias("projected_revenue"),
        F.when(closed, _pct(proj - F.col("a_revenue"), F.col("a_revenue")))
        .when(live, _pct(F.col("revenue_to_date_cents"), proj)).alias("pct_of_projection_achieved"),
    )
    return out.orderBy("billing_interval", "target_end")
