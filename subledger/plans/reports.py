"""Published consumer queries (the "How to query" examples) over the marts.

Top-k reports order by the measure and then by the key, so the rows kept at the
cut are deterministic; ``orderBy(...).limit(k)`` plans as a per-partition top-k
(``TakeOrderedAndProject``) without a global sort.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.functions.money import round_div, to_major, to_minor
from subledger.operators.joins import bounded_broadcast
from subledger.operators.pivot import pivot_measures, pivot_sum


# ------------------------------------------------------------------ revenue
def month_revenue(month_accrual: DataFrame, month: str) -> DataFrame:
    """CQ1: recognised revenue of one fiscal month, one row per stream/interval."""
    return (month_accrual.where(F.col("reporting_month") == month)
            .select("reporting_month", "reporting_month_start", "reporting_month_end",
                    "revenue_type", "billing_interval", "recognized_revenue_usd")
            .orderBy("revenue_type", "billing_interval"))


def revenue_trend(month_accrual: DataFrame) -> DataFrame:
    """CQ2: month-over-month revenue pivoted by interval and stream."""
    cents = F.col("recognized_revenue_cents")
    measures = (pivot_measures(F.col("billing_interval"), cents,
                               [("monthly_sub_cents", "monthly"), ("annual_sub_cents", "annual")])
                + pivot_measures(F.col("revenue_type"), cents, [("app_store_cents", "app_store")])
                + [F.sum(cents).alias("total_cents")])
    p = pivot_sum(month_accrual, ["reporting_month", "reporting_month_start"], measures)
    return p.select("reporting_month", "reporting_month_start",
                    to_major("monthly_sub_cents").alias("monthly_sub_revenue"),
                    to_major("annual_sub_cents").alias("annual_sub_revenue"),
                    to_major("app_store_cents").alias("app_store_revenue"),
                    to_major("total_cents").alias("total_revenue")
                    ).orderBy(F.col("reporting_month_start").desc())


def charge_trace(charge_accrual: DataFrame, charge_id=None) -> DataFrame:
    """CQ3: the monthly slices of one annual charge (default: the lowest annual id)."""
    cols = ["charge_id", "email", "charged_at", "settled_amount_usd", "billing_interval",
            "month_offset", "reporting_month", "reporting_month_start", "reporting_month_end",
            "recognized_revenue_usd"]
    if charge_id is not None:
        picked = charge_accrual.where(F.col("charge_id") == charge_id)
    else:
        pick = charge_accrual.where(F.col("billing_interval") == "annual").agg(
            F.min("charge_id").alias("__pick"))
        pick = bounded_broadcast(pick, "a global aggregate: one row")
        picked = charge_accrual.join(pick, F.col("charge_id") == F.col("__pick"), "inner")
    return picked.select(*cols).orderBy("month_offset")


def live_projection(projections: DataFrame) -> DataFrame:
    """CQ4: the in-progress month of the projection model."""
    return (projections.where(F.col("row_type") == "live")
            .select("reporting_month", "target_start", "target_end", "billing_interval",
                    "pct_period_elapsed", "actual_revenue", "projected_revenue",
                    "pct_of_projection_achieved", "starts_prorated", "churn_prorated")
            .orderBy("billing_interval"))


# -------------------------------------------------------------------- posts
def _since(col: str, as_of: dt.date, days: int):
    return F.to_date(col) >= F.lit(as_of - dt.timedelta(days=days))


def top_posts_by_open_rate(overview: DataFrame, publication: str, as_of: dt.date,
                           days: int = 90, k: int = 20) -> DataFrame:
    """CQ5: best open rates of one publication vs its comparable-post average."""
    o = overview.where((F.col("publication") == publication) & _since("post_date", as_of, days)
                       & (F.col("sent") > 0))
    pct = F.round((F.col("open_rate") - F.col("pub_avg_open_rate"))
                  / F.nullif(F.col("pub_avg_open_rate"), F.lit(0.0)) * 100, 1)
    return (o.select("post_id", "publication", "title", "post_date", "sent", "open_rate",
                     "pub_avg_open_rate", pct.alias("pct_above_avg"), "click_through_rate",
                     "subscribes")
             .orderBy(F.col("open_rate").desc_nulls_last(), F.col("post_id")).limit(k))


def top_converting_posts(overview: DataFrame, growth: DataFrame, as_of: dt.date,
                         days: int = 180, k: int = 25) -> DataFrame:
    """CQ6: posts that drove the most paid subscriptions."""
    o = overview.where(_since("post_date", as_of, days)).select(
        "post_id", "publication", "title", "post_date", "views", "open_rate")
    g = growth.select("post_id", "subscribes", "monthly_subscribes", "annual_subscribes",
                      "unsubscribes")
    j = o.join(g, "post_id", "inner")
    return (j.select("post_id", "publication", "title", "post_date", "views", "open_rate",
                     "subscribes", "monthly_subscribes", "annual_subscribes", "unsubscribes",
                     (F.col("subscribes") - F.col("unsubscribes")).alias("net_subscriber_change"))
             .orderBy(F.col("subscribes").desc_nulls_last(), F.col("post_id")).limit(k))


TRAFFIC_REPORT_COLUMNS = [
    "post_id", "referrer_views_email", "referrer_views_search", "referrer_views_social",
    "referrer_views_direct", "referrer_views_substack", "paid_views_email", "paid_views_search",
    "paid_views_social", "free_views_email", "free_views_search", "free_views_social",
    "device_views_email", "device_views_desktop_web", "device_views_mobile_web",
    "device_views_substack_app"]


def post_traffic_breakdown(traffic: DataFrame, post_id) -> DataFrame:
    """CQ7: where one post's readers came from."""
    return traffic.where(F.col("post_id") == post_id).select(*TRAFFIC_REPORT_COLUMNS)


def threaded_comments(comments: DataFrame, post_id) -> DataFrame:
    """CQ8: a post's comments with replies under their parent."""
    c = comments.where(F.col("post_id") == post_id)
    kind = F.when(F.col("parent_comment_id").isNull(), "top-level").otherwise("reply")
    return (c.select("comment_id", "parent_comment_id", kind.alias("comment_type"), "body",
                     "snapshot_date")
             .orderBy(F.coalesce("parent_comment_id", "comment_id"),
                      F.col("parent_comment_id").isNotNull(), "comment_id"))


# Fixed value: rates are averaged as integer millionths so the sum is exact.
RATE_SCALE = 1_000_000


def _avg_pct(col: str):
    """round(avg(rate) * 100, 1) over exact integer millionths."""
    return round_div(F.sum(to_minor(col, RATE_SCALE)), F.count(col) * (RATE_SCALE // 1000)) / 10.0


def publication_summary(overview: DataFrame, growth: DataFrame, as_of: dt.date,
                        days: int = 30) -> DataFrame:
    """CQ9: cross-publication post performance over the last ``days`` days."""
    o = overview.where(_since("post_date", as_of, days)).select(
        "post_id", "publication", "open_rate", "click_through_rate", "views")
    g = growth.select("post_id", F.col("subscribes").alias("g_subscribes"),
                      F.col("unsubscribes").alias("g_unsubscribes"))
    j = o.join(g, "post_id", "left")
    return (j.groupBy("publication").agg(
        F.count_distinct("post_id").alias("posts_published"),
        _avg_pct("open_rate").alias("avg_open_rate_pct"),
        _avg_pct("click_through_rate").alias("avg_ctr_pct"),
        F.sum("views").alias("total_views"),
        F.sum("g_subscribes").alias("total_new_subs"),
        F.sum("g_unsubscribes").alias("total_unsubs"),
        F.sum(F.col("g_subscribes") - F.col("g_unsubscribes")).alias("net_sub_change"),
    ).orderBy(F.col("total_views").desc_nulls_last()))
