"""The declared data checks of the models and landing tables."""

from __future__ import annotations

from subledger.operators.quality import ModelChecks

# Fixed value: freshness warning threshold of the landing tables, in days.
FRESHNESS_WARN_DAYS = 10

# Model -> columns that must hold a value, the column whose values must not repeat, accepted values.
# `equal` is a documented expectation without a declared test (the payload's id), reported as a warning.
_DECLARED = [
    ModelChecks("stg_charges", ("charge_id", "charged_at"), "charge_id"),
    ModelChecks("stg_invoices", ("invoice_id", "customer_id"), "invoice_id"),
    ModelChecks("stg_customers", ("customer_id",), "customer_id"),
    ModelChecks("stg_subscriptions", ("subscription_id", "customer_id")),
    ModelChecks("stg_subscribers", ("snapshot_date",)),
    ModelChecks("stg_post_overview",
                ("post_id", "snapshot_date", "post_uuid", "title", "is_published", "publication_id", "post_date"),
                equal=(("post_id_check", "post_id"),)),
    ModelChecks("stg_post_traffic", ("post_id", "snapshot_date")),
    ModelChecks("stg_post_growth", ("post_id", "snapshot_date")),
    ModelChecks("stg_post_comments", ("comment_id", "post_id", "snapshot_date")),
    ModelChecks("int_subscriptions", ("subscription_id",), "subscription_id"),
    ModelChecks("int_charges", ("charge_id",)),
    ModelChecks("int_payouts", ("charge_id",), "charge_id"),
    ModelChecks("int_subscriber_daily", ("snapshot_date",)),
    ModelChecks("int_post_overview", ("post_id", "snapshot_date"), "post_id"),
    ModelChecks("charge_accrual", ("charge_id",)),
    ModelChecks("month_accrual", ("reporting_month", "revenue_type"),
                accepted={"revenue_type": ("subscriber", "app_store")}),
    ModelChecks("revenue_projections", ("reporting_month", "billing_interval", "row_type"),
                accepted={"billing_interval": ("monthly", "annual"), "row_type": ("closed", "live")}),
    ModelChecks("subscriber_daily", ("snapshot_date",)),
]
MODEL_CHECKS = {c.model: c for c in _DECLARED}

# Landing table -> columns that must hold a value.
_LANDING_NOT_NULL = {
    "subscribers_snapshot": ("snapshot_date",),
    "post_overview": ("post_id", "snapshot_date", "data"),
    "post_traffic": ("post_id", "snapshot_date", "data"),
    "post_growth": ("post_id", "snapshot_date"),
    "post_comments": ("comment_id", "post_id", "snapshot_date"),
}
LANDING_CHECKS = {t: ModelChecks(t, columns, freshness=("snapshot_date", FRESHNESS_WARN_DAYS))
                  for t, columns in _LANDING_NOT_NULL.items()}
#: Landing table -> the staging model whose write reads every row of it.
LANDING_READ_BY = {"subscribers_snapshot": "stg_subscribers", "post_overview": "stg_post_overview",
                   "post_traffic": "stg_post_traffic", "post_growth": "stg_post_growth", "post_comments": "stg_post_comments"}
