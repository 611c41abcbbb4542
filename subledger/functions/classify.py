"""Row classifiers written as ``CASE`` chains over columns.

Branch order matters and follows SQL semantics: a NULL condition falls through
to the next branch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Billing-interval vocabulary and the in-app purchase attribution tag.
ANNUAL, MONTHLY = "annual", "monthly"
IOS_ATTRIBUTION = "substack-ios-in-app-purchase"
ACTIVE_BUCKETS = ("Active", "Cancelled but Active")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def plan_interval(plan_interval_col) -> Column:
    """Plan ``year`` -> annual, anything else (month, week, ...) -> monthly."""
    c = _col(plan_interval_col)
    return F.when(c == "year", ANNUAL).when(c == "month", MONTHLY).otherwise(MONTHLY)


def resolve_interval(payment_interval, export_interval, plan_text) -> Column:
    """Payment-system interval, else the export's interval, else a word in the plan text."""
    export = _col(export_interval)
    text = F.lower(_col(plan_text))
    return F.coalesce(
        _col(payment_interval),
        F.when(export == ANNUAL, ANNUAL).when(export == MONTHLY, MONTHLY),
        F.when(text.like("%year%"), ANNUAL).when(text.like("%month%"), MONTHLY),
    )


def payer_type(paid_source, is_comp, is_gift, payment_subscription_id) -> Column:
    return (F.when(_col(paid_source) == IOS_ATTRIBUTION, "ios")
            .when(_col(is_comp), "comp")
            .when(_col(is_gift), "gift")
            .when(_col(payment_subscription_id).isNotNull(), "stripe")
            .otherwise("free"))


def status_bucket(is_gift, first_paid, is_comp, cancel_date, expiration, snapshot_date) -> Column:
    """Active / Cancelled but Active / Expired / Non-paid as of the snapshot day.

    Expiry is compared strictly with midnight of the snapshot date.
    """
    live = _col(expiration).cast("timestamp_ntz") > _col(snapshot_date).cast("timestamp_ntz")
    return (F.when(_col(is_gift), F.when(live, "Active").otherwise("Expired"))
            .when(_col(first_paid).isNull() & ~F.coalesce(_col(is_comp), F.lit(False)), "Non-paid")
            .when(_col(cancel_date).isNotNull(),
                  F.when(live, "Cancelled but Active").otherwise("Expired"))
            .when(_col(expiration).isNull(), "Expired")
            .when(live, "Active")
            .otherwise("Expired"))


def interval_by_amount(amount, threshold: float = 10.0) -> Column:
    """Prototype rule: converted amount below the threshold -> monthly, else annual."""
    return F.when(_col(amount) < threshold, MONTHLY).otherwise(ANNUAL)


def title_or_free(interval) -> Column:
    return F.coalesce(F.initcap(_col(interval)), F.lit("Free"))
