"""Subscriber models: export snapshots -> daily enriched facts -> status buckets.

Grain: one row per subscription per snapshot day.  The payment enrichment is a
left join on the normalised e-mail against one subscription per e-mail (the
most recently created); snapshot rows without an e-mail bypass that shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.functions.classify import ACTIVE_BUCKETS, payer_type, resolve_interval, status_bucket, title_or_free
from subledger.functions.money import to_major
from subledger.functions.text import imputed_price, normalise_email, source_uri
from subledger.operators.dedup import latest_per_key
from subledger.operators.joins import left_join_on

# Fixed value: days recomputed by an incremental refresh of the daily fact.
LOOKBACK_DAYS = 3

# export struct field -> column name
SUB_FIELDS = [
    ("subscription_id", "subscription_id"), ("user_id", "user_id"),
    ("user_email_address", "email"), ("user_name", "name"), ("subscriber", "type"),
    ("stripe_plan_name", "stripe_plan"), ("is_subscribed", "is_subscribed"),
    ("is_comp", "is_comp"), ("is_gift", "is_gift"), ("is_free_trial", "is_free_trial"),
    ("subscription_interval", "subscription_interval"),
    ("subscription_created_at", "start_date"), ("first_payment_at", "first_paid_date"),
    ("subscription_expires_at", "expiration_date"), ("unsubscribed_at", "cancel_date"),
]
SUB_TAIL = [("country", "country"), ("paid_attribution", "paid_source"),
            ("free_attribution", "free_source"), ("activity_rating", "activity"),
            ("total_count", "total_count")]


def stg_subscribers(snapshot: DataFrame) -> DataFrame:
    """Flatten the export struct; revenue from minor units."""
    return snapshot.select(
        F.to_date("snapshot_date").alias("snapshot_date"),
        F.col("snapshot_date").alias("snapshot_ts"),
        source_uri("publication").alias("source_uri"),
        "publication",
        *[F.col(f"sub.{src}").alias(dst) for src, dst in SUB_FIELDS],
        to_major("sub.total_revenue_generated").alias("revenue"),
        *[F.col(f"sub.{src}").alias(dst) for src, dst in SUB_TAIL],
    )


def latest_subscription_per_email(subscriptions: DataFrame) -> DataFrame:
    """Most recently created payment subscription per normalised e-mail."""
    s = subscriptions.where(normalise_email("email").isNotNull()).select(
        F.col("subscription_id").alias("stripe_subscription_id"),
        F.col("email").alias("stripe_email"),
        F.col("billing_interval").alias("stripe_billing_interval"),
        F.col("status").alias("stripe_status"),
        "current_period_start", "current_period_end", "cancel_at_period_end", "canceled_at",
        "subscription_created_at", normalise_email("email").alias("email_key"))
    return latest_per_key(s, ["email_key"], ["subscription_created_at"],
                          ["stripe_subscription_id"]).drop("email_key")


def int_subscriber_daily(subscribers: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Snapshot rows enriched with the payment subscription of the same e-mail."""
    stripe = latest_subscription_per_email(subscriptions)
    j = left_join_on(subscribers, stripe, normalise_email("email"), normalise_email("stripe_email"),
                     ["subscription_id", "snapshot_date"])
    return j.select(
        "snapshot_date", "snapshot_ts", "source_uri", "publication", "subscription_id", "user_id",
        "email", "name", "type", "subscription_interval", "stripe_plan", "country", "paid_source",
        "free_source", "is_subscribed", "is_comp", "is_gift", "is_free_trial", "activity",
        "start_date", "first_paid_date", "expiration_date", "cancel_date",
        "stripe_subscription_id", "stripe_status", "current_period_start", "current_period_end",
        "cancel_at_period_end", "canceled_at",
        resolve_interval("stripe_billing_interval", "subscription_interval",
                         "stripe_plan").alias("billing_interval"),
        imputed_price("stripe_plan").alias("imputed_price_usd"),
        (F.col("first_paid_date").isNotNull() & F.col("stripe_subscription_id").isNull())
        .alias("is_non_stripe_paid"),
        payer_type("paid_source", "is_comp", "is_gift", "stripe_subscription_id").alias("payer_type"),
    )


def incremental_window(daily: DataFrame, as_of: dt.date | None,
                       lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Rows a refresh recomputes: all on the first run (``as_of`` None), else the
    last ``lookback_days`` days up to ``as_of``.  The predicate is on the
    partition column, so a partitioned upstream prunes whole directories."""
    if as_of is None:
        return daily
    return daily.where(F.col("snapshot_date") >= F.lit(as_of - dt.timedelta(days=lookback_days)))


def fct_subscriber_daily(daily: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    base = incremental_window(daily, as_of)
    bucket = status_bucket("is_gift", "first_paid_date", "is_comp", "cancel_date",
                           "expiration_date", "snapshot_date")
    return (base.withColumn("status_bucket", bucket)
                .withColumn("is_active_paid", F.col("status_bucket").isin(*ACTIVE_BUCKETS)))


#: Legacy export shape (built with the upstream column names), as the stored view defines it.
COMPAT_SQL = """
SELECT snapshot_date, email, CAST(NULL AS STRING) AS name,
       CASE WHEN is_gift AND billing_interval = 'monthly' THEN 'monthly gift'
            WHEN is_gift AND billing_interval = 'annual' THEN 'yearly gift'
            WHEN subscription_interval = 'lifetime' THEN 'royalist'
            WHEN is_comp THEN 'comp'
            WHEN billing_interval = 'annual' THEN 'yearly'
            WHEN billing_interval = 'monthly' THEN 'monthly'
            ELSE 'subscriber' END AS type,
       start_date, first_paid_date, cancel_date, expiration_date, imputed_price_usd AS revenue
FROM {daily}"""


def subscriber_compat(daily_fact: DataFrame) -> DataFrame:
    return daily_fact.sparkSession.sql(COMPAT_SQL, daily=daily_fact)


def subscribers_mapped(subscribers: DataFrame) -> DataFrame:
    """Snapshot rows in the subscriber-list shape (type label, typed NULL sections)."""
    return subscribers.select(
        "snapshot_date", "snapshot_ts", "source_uri", "email", "name",
        title_or_free("subscription_interval").alias("type"), "stripe_plan", "cancel_date",
        "start_date", "expiration_date", "first_paid_date", "revenue", "country", "paid_source",
        "free_source", "activity", F.lit(None).cast("string").alias("sections"),
        "publication", "subscription_id", "subscription_interval", "is_subscribed", "is_comp",
        "is_gift", "is_free_trial", "total_count")


def int_subscribers(subscribers: DataFrame) -> DataFrame:
    """Latest snapshot row per subscription, with the export type label."""
    return latest_per_key(subscribers_mapped(subscribers), ["subscription_id"], ["snapshot_date"],
                          ["publication"])


def subscriber_history(subscribers: DataFrame) -> DataFrame:
    """SCD2 history of the subscriber list as a daily snapshot run would record it.

    Replaying one run per snapshot day: a subscription opens a version on its
    first day and a new one whenever a watched column changes (NULL-safe) from
    its previous day's row; ``dbt_valid_to`` is the next version's start.  Each
    window partition holds one subscription's days, bounded by the calendar.
    """
    from subledger.sinks.history import history_from_snapshots
    daily = latest_per_key(subscribers_mapped(subscribers), ["subscription_id", "snapshot_date"],
                           ["publication"])
    return history_from_snapshots(daily, "subscription_id", ["cancel_date"], "snapshot_date")


def last_snapshot_day(subscribers: DataFrame, publication: str) -> DataFrame:
    """Most recent snapshot date of one publication."""
    return (subscribers.where(F.col("publication") == publication)
                       .agg(F.max("snapshot_date").alias("last_day")))
