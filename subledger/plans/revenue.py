"""Revenue models: payments staging -> recognised charges -> monthly accrual.

Every function takes and returns DataFrames (lazy); composing them builds one
logical plan per mart, so Catalyst prunes columns and pushes filters all the way
to the scans, and identical sub-plans read twice are planned once
(``ReusedExchange``).  Amounts are carried in integer ``*_cents`` columns next to
the USD columns of the reference so sums stay exact.

Shuffle keys, in order: charge id (refund totals), settlement id, invoice id,
subscription id, e-mail; after the spread everything aggregates to
month x interval x stream.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.functions import fiscal
from subledger.functions.classify import ANNUAL, plan_interval
from subledger.functions.money import round_div, to_major
from subledger.functions.text import PAYOUT_PREFIX, payout_label
from subledger.operators.dedup import latest_per_key
from subledger.operators.distinct import bitmaps, counted, merged, with_dense_number
from subledger.operators.joins import left_join_agg, left_join_on
from subledger.operators.spread import SPREAD_MONTHS, spread_revenue
from subledger.sinks.colocated import Part, colocated_join

SUCCEEDED = "succeeded"
SUBSCRIBER, APP_STORE = "subscriber", "app_store"


# ----------------------------------------------------------------- staging
def stg_refunds(refund: DataFrame, balance_transaction: DataFrame) -> DataFrame:
    """Succeeded refunds with the absolute settled net (NULL without settlement)."""
    r = refund.where(F.col("status") == SUCCEEDED).select(
        F.col("id").alias("refund_id"), "charge_id", "balance_transaction_id",
        F.col("created").alias("refunded_at"))
    bt = balance_transaction.select(F.col("id").alias("bt_id"),
                                    F.abs("net").alias("refunded_net_cents"))
    return (left_join_on(r, bt, F.col("balance_transaction_id"), F.col("bt_id"), ["refund_id"])
             .select("refund_id", "charge_id", "refunded_at",
                     to_major("refunded_net_cents").alias("refunded_net_usd"), "refunded_net_cents"))


def stg_charges(charge: DataFrame, balance_transaction: DataFrame, refunds: DataFrame) -> DataFrame:
    """Net of refunds: settlement net minus the sum of refunded nets per charge.

    A charge without settlement keeps a NULL net even when refunds exist.
    """
    c = charge.where(F.col("status") == SUCCEEDED).select(
        F.col("id").alias("charge_id"), "customer_id", "invoice_id", "balance_transaction_id",
        F.col("created").alias("charged_at"),
        to_major("amount").alias("charge_amount"),
        F.lower("currency").alias("charge_currency"), "receipt_email", "description")
    bt = balance_transaction.select(
        F.col("id").alias("bt_id"), F.col("amount").alias("settled_cents"),
        F.col("fee").alias("fee_cents"), F.col("net").alias("bt_net_cents"), "exchange_rate")
    joined = left_join_on(c, bt, F.col("balance_transaction_id"), F.col("bt_id"), ["charge_id"])
    joined = left_join_agg(joined, refunds, "charge_id",
                           [F.sum("refunded_net_cents").alias("refunded_cents")])
    net = F.col("bt_net_cents") - F.coalesce(F.col("refunded_cents"), F.lit(0))
    return joined.select(
        "charge_id", "customer_id", "invoice_id", "balance_transaction_id", "charged_at",
        "charge_amount", "charge_currency", "receipt_email", "description",
        to_major("settled_cents").alias("settled_amount_usd"),
        to_major("fee_cents").alias("stripe_fee_usd"),
        to_major(net).alias("net_amount_usd"),
        "exchange_rate",
        F.col("settled_cents").alias("settled_amount_cents"),
        net.alias("net_amount_cents"))


def stg_invoices(invoice: DataFrame) -> DataFrame:
    return invoice.select(
        F.col("id").alias("invoice_id"), "subscription_id", "customer_id",
        F.col("created").alias("invoice_created_at"), "period_start", "period_end",
        to_major("amount_paid").alias("amount_paid_usd"), F.lower("currency").alias("currency"),
        "status")


def stg_plans(plan: DataFrame) -> DataFrame:
    return plan.select(F.col("id").alias("plan_id"), F.col("interval").alias("billing_interval"),
                       "interval_count", to_major("amount").alias("amount_usd"), "currency", "active")


def stg_subscriptions(subscription_history: DataFrame) -> DataFrame:
    """Subscription versions (SCD2 rows of the replicated history table)."""
    return subscription_history.select(
        F.col("id").alias("subscription_id"), "customer_id", "status", "current_period_start",
        "current_period_end", "cancel_at_period_end", "cancel_at", "canceled_at", "ended_at",
        F.col("created").alias("subscription_created_at"), "start_date", "trial_start",
        "trial_end", "_fivetran_active", "_fivetran_start", "_fivetran_end")


def stg_subscription_items(subscription_item: DataFrame) -> DataFrame:
    return subscription_item.select(F.col("id").alias("subscription_item_id"), "subscription_id",
                                     "plan_id", "created", "_fivetran_synced")


def stg_customers(customer: DataFrame) -> DataFrame:
    return customer.select(F.col("id").alias("customer_id"), "email", "name",
                           F.col("created").alias("customer_created_at"), "delinquent")


# ------------------------------------------------------------ intermediate
def subscription_plans(items: DataFrame, plans: DataFrame) -> DataFrame:
    """Billing interval of each subscription from its most recent item's plan."""
    joined = items.join(plans.select("plan_id", F.col("billing_interval").alias("plan_interval")),
                        "plan_id", "inner")
    latest = latest_per_key(joined, ["subscription_id"], ["created"], ["subscription_item_id"])
    return latest.select("subscription_id", plan_interval("plan_interval").alias("billing_interval"))


def last_invoices(invoices: DataFrame, charges: DataFrame) -> DataFrame:
    """Latest invoice per subscription with the settled amount of its charge: the invoice is picked first, so
    only those rows meet the charges."""
    inv = latest_per_key(invoices.where(F.col("subscription_id").isNotNull()), ["subscription_id"],
                         ["invoice_created_at"], ["invoice_id"])
    ch = latest_per_key(
        charges.where(F.col("invoice_id").isNotNull()).select(
            F.col("invoice_id").alias("ch_invoice_id"), "charge_id", "settled_amount_usd", "net_amount_usd"),
        ["ch_invoice_id"], ["charge_id"])
    joined = inv.join(ch, inv.invoice_id == ch.ch_invoice_id, "left")
    return joined.select(
        "subscription_id", "period_start", "period_end",
        F.datediff(F.to_date("period_end"), F.to_date("period_start")).alias("period_days"),
        F.col("settled_amount_usd").alias("amount_paid_usd"), "net_amount_usd")


def current_subscriptions(subscriptions: DataFrame, items: DataFrame, plans: DataFrame) -> DataFrame:
    """Latest version of each subscription with the interval of its plan: what recognition and projections read.

    Customer and invoice columns are joined by ``int_subscriptions`` only, as a left join stays in a plan even
    when none of its columns is read."""
    subs = latest_per_key(subscriptions, ["subscription_id"], ["_fivetran_start"], ["_fivetran_end"])
    sp = subscription_plans(items, plans).withColumnRenamed("billing_interval", "plan_billing_interval")
    return subs.join(sp, "subscription_id", "left").select(
        "subscription_id", "customer_id", "status", "cancel_at_period_end", "canceled_at", "ended_at",
        "subscription_created_at",
        F.coalesce("plan_billing_interval", F.lit("monthly")).alias("billing_interval"))


def int_subscriptions(current: DataFrame, customers: DataFrame, invoices: DataFrame,
                      charges: DataFrame) -> DataFrame:
    """Current subscription with its customer's e-mail and its last invoice."""
    cust = customers.select(F.col("customer_id").alias("c_customer_id"), "email")
    inv = last_invoices(invoices, charges)
    out = (left_join_on(current, cust, F.col("customer_id"), F.col("c_customer_id"), ["subscription_id"])
               .join(inv, "subscription_id", "left"))
    return out.select(
        "subscription_id", "customer_id", "email", "status",
        F.col("period_start").alias("current_period_start"),
        F.col("period_end").alias("current_period_end"),
        "cancel_at_period_end", "canceled_at", "ended_at", "subscription_created_at",
        "billing_interval", F.col("amount_paid_usd").alias("last_invoice_amount_usd"))


def latest_export_interval(subscribers: DataFrame) -> DataFrame:
    """Export's subscription interval of the latest snapshot per (raw) e-mail.

    NULL e-mails can never match the e-mail join, so they are dropped first.
    """
    ss = subscribers.where(F.col("email").isNotNull()).select(
        "email", "subscription_interval", "snapshot_date", "subscription_id")
    latest = latest_per_key(ss, ["email"], ["snapshot_date"], ["subscription_id"])
    return latest.select(F.col("email").alias("ss_email"),
                         F.col("subscription_interval").alias("ss_subscription_interval"))


def recognised_charges(charges: DataFrame, invoices: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Invoice-linked charges of subscriptions with their fiscal month, one row per charge, and the columns of ``subscriptions``."""
    ch = charges.where(F.col("invoice_id").isNotNull()).select(
        "charge_id", "invoice_id", "charged_at", "charge_currency", "exchange_rate",
        "settled_amount_usd", "net_amount_usd", "net_amount_cents")
    inv = invoices.where(F.col("subscription_id").isNotNull()).select(
        F.col("invoice_id").alias("inv_invoice_id"), "subscription_id")
    base = (ch.join(inv, ch.invoice_id == inv.inv_invoice_id, "inner")
              .join(_linked_to(subscriptions), "subscription_id", "inner"))
    return base.withColumn("finance_month_date", fiscal.fiscal_month("charged_at"))


def _linked_to(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.select("subscription_id", "customer_id", "billing_interval",
                                *[c for c in ("email", "ss_subscription_interval") if c in subscriptions.columns])


def revenue_streams(charges: DataFrame, invoices: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Both streams in one pass over the charges, a row per charge and stream: ``subscriber`` where an invoice links the charge to
    a subscription, ``app_store`` where it is a bulk payout (whose subscription columns are NULL)."""
    payout = F.coalesce(F.col("description").startswith(PAYOUT_PREFIX), F.lit(False))
    ch = charges.where(F.col("invoice_id").isNotNull() | payout).select(
        "charge_id", "invoice_id", "charged_at", "charge_currency", "exchange_rate", "settled_amount_usd", "net_amount_usd",
        "net_amount_cents", payout.alias("is_payout"))
    inv = invoices.where(F.col("subscription_id").isNotNull()).select(
        F.col("invoice_id").alias("inv_invoice_id"), F.col("subscription_id").alias("inv_subscription_id"))
    subs = _linked_to(subscriptions)
    linked = left_join_on(ch, inv, F.col("invoice_id"), F.col("inv_invoice_id"), ["charge_id"])
    linked = left_join_on(linked, subs, F.col("inv_subscription_id"), F.col("subscription_id"), ["charge_id"])
    rows = linked.withColumn("revenue_type", F.explode(F.array_compact(F.array(
        F.when(F.col("subscription_id").isNotNull(), F.lit(SUBSCRIBER)), F.when(F.col("is_payout"), F.lit(APP_STORE))))))
    subscriber = F.col("revenue_type") == SUBSCRIBER
    return rows.withColumns({c: F.when(subscriber, F.col(c)) for c in [*subs.columns, "exchange_rate"]}).withColumn(
        "finance_month_date", fiscal.fiscal_month("charged_at"))


def charge_chain_parts(charges: DataFrame, invoices: DataFrame, subscriptions: DataFrame) -> dict[str, Part]:
    """Charges, invoices and subscriptions for ``write_colocated``: each row carries its subscription, which charges get from their
    invoice here, once, when they are stored."""
    inv = invoices.where(F.col("subscription_id").isNotNull())
    of = inv.select(F.col("invoice_id").alias("of_invoice"), "subscription_id")
    ch = charges.where(F.col("invoice_id").isNotNull()).select("charge_id", "invoice_id", "charged_at", "net_amount_usd")
    ch = ch.join(of, F.col("invoice_id") == F.col("of_invoice"), "inner").drop("of_invoice")
    return {"charges": Part(ch, "invoice_id"),
            "invoices": Part(inv.select("subscription_id", "invoice_id", "period_start"), "invoice_id"),
            "subscriptions": Part(subscriptions.select("subscription_id", "customer_id", "billing_interval"))}


def charge_chain(tables: dict[str, DataFrame]) -> DataFrame:
    """Charge -> invoice -> subscription over the stored tables, without an exchange."""
    linked = colocated_join(tables["charges"], tables["invoices"], "subscription_id", "invoice_id")
    return colocated_join(linked, tables["subscriptions"], "subscription_id").select(
        "charge_id", "invoice_id", "subscription_id", "customer_id", "billing_interval", "period_start", "charged_at", "net_amount_usd")


def recognition_months(base: DataFrame) -> DataFrame:
    """One row per charge and recognition month: what the projections read of the accrual."""
    spread = spread_revenue(base, "billing_interval", "net_amount_cents")
    month = F.add_months("finance_month_date", F.col("month_offset"))
    return spread.withColumns({
        "reporting_month": fiscal.month_label(month), "reporting_month_date": month,
        "recognized_revenue_usd": to_major("recognized_revenue_cents"),
        "month_offset": F.col("month_offset").cast("bigint")})


def subscription_contacts(current: DataFrame, customers: DataFrame, subscribers: DataFrame) -> DataFrame:
    """Subscriptions with their customer's e-mail and the export's interval: attached here, once per subscription, so that charges
    are joined to subscriptions only."""
    cust = customers.select(F.col("customer_id").alias("c_customer_id"), "email")
    subs = current.select("subscription_id", "customer_id", "billing_interval")
    subs = left_join_on(subs, cust, F.col("customer_id"), F.col("c_customer_id"), ["subscription_id"])
    subs = left_join_on(subs, latest_export_interval(subscribers), F.col("email"), F.col("ss_email"), ["subscription_id"])
    return subs.select("subscription_id", "customer_id", "billing_interval", "email", "ss_subscription_interval")


def int_charges(base: DataFrame) -> DataFrame:
    """``recognised_charges`` of ``subscription_contacts``, one row per recognition month."""
    return recognition_months(base).select(
        "charge_id", "subscription_id", "customer_id", "email", "billing_interval",
        "ss_subscription_interval", "charged_at", "charge_currency", "exchange_rate",
        "settled_amount_usd", "net_amount_usd", "reporting_month", "recognized_revenue_usd",
        "month_offset", "net_amount_cents", "recognized_revenue_cents", "reporting_month_date")


def int_payouts(charges: DataFrame) -> DataFrame:
    """Bulk app-store payouts, put on the fiscal month of the charge date."""
    src = charges.where(F.col("description").startswith(PAYOUT_PREFIX))
    m = fiscal.fiscal_month("charged_at")
    return src.select(
        "charge_id", "charged_at", "description", "settled_amount_usd", "net_amount_usd",
        "charge_currency", payout_label("description").alias("payout_month_label"),
        fiscal.month_label(m).alias("reporting_month"),
        fiscal.period_start(m).alias("reporting_month_start"),
        fiscal.period_end(m).alias("reporting_month_end"),
        "net_amount_cents", m.alias("reporting_month_date"))


# -------------------------------------------------------------------- marts
def charge_dates_of(label: str) -> tuple[dt.date, dt.date]:
    """From (included) and to (not included) when a charge must have come to be recognised in the month ``label``:
    its fiscal period and those of the months before that an annual charge is spread over."""
    month = dt.datetime.strptime(label, "%B %Y").date()
    back = month.year * 12 + month.month - SPREAD_MONTHS
    first = dt.date(back // 12, back % 12 + 1, fiscal.CUT_DAY)
    return first, (month + dt.timedelta(days=32)).replace(day=fiscal.CUT_DAY)


def subscriber_accrual(base: DataFrame) -> DataFrame:
    """Charge x month rows of the subscriber stream, without the columns of other joins."""
    return _accrual_columns(recognition_months(base).select(
        "charge_id", "subscription_id", "billing_interval", "reporting_month", "month_offset",
        F.lit(SUBSCRIBER).alias("revenue_type"), "recognized_revenue_cents", "reporting_month_date"))


def charge_accrual(streams: DataFrame) -> DataFrame:
    """Both revenue streams at charge x month grain, with payer channel and period (``streams`` of ``subscription_contacts``)."""
    return _accrual_columns(recognition_months(streams).select(
        "charge_id", "subscription_id", "customer_id", "email", "billing_interval",
        "ss_subscription_interval", "charged_at", "charge_currency", "exchange_rate",
        "settled_amount_usd", "net_amount_usd", "reporting_month", "recognized_revenue_usd",
        "month_offset", "revenue_type", "net_amount_cents", "recognized_revenue_cents", "reporting_month_date"))


def _accrual_columns(both: DataFrame) -> DataFrame:
    payer = F.when(F.col("revenue_type") == APP_STORE, "ios").when(
        F.col("revenue_type") == SUBSCRIBER, "stripe")
    return both.withColumns({
        "payer_type": payer,
        "reporting_month_start": fiscal.period_start("reporting_month_date"),
        "reporting_month_end": fiscal.period_end("reporting_month_date"),
    })


def customer_months(streams: DataFrame) -> DataFrame:
    """The customers charged in each fiscal month, stream and interval as bitmaps, with the month's cents and charges.

    The slice of a charge is rounded before the sum, so sums of slices are those of the spread charges.  Customers get dense numbers
    once each has one row (at most one entry per month, stream and interval); the bitmaps of any months can then be merged.
    """
    slice_cents = F.when(F.col("billing_interval") == ANNUAL, round_div(F.col("net_amount_cents"), F.lit(SPREAD_MONTHS))) \
        .otherwise(F.col("net_amount_cents"))
    per_customer = streams.groupBy("finance_month_date", "revenue_type", "billing_interval", "customer_id").agg(
        F.sum(slice_cents).alias("cents"), F.count_distinct("charge_id").alias("charges"))
    customers = with_dense_number(per_customer.groupBy("customer_id").agg(F.collect_list(
        F.struct("finance_month_date", "revenue_type", "billing_interval", "cents", "charges")).alias("months")), "customer_id")
    return bitmaps(customers.select("number", F.inline("months")), ["finance_month_date", "revenue_type", "billing_interval"],
                   "number", F.sum("cents").alias("cents"), F.sum("charges").alias("charges"))


def trailing_customers(months: DataFrame, span: int) -> DataFrame:
    """Distinct customers charged in each fiscal month and the ``span - 1`` before it, of all intervals of the subscriber stream."""
    reach = months.where(F.col("revenue_type") == SUBSCRIBER).withColumn(
        "back", F.explode(F.sequence(F.lit(0), F.lit(span - 1)))).withColumn(
        "month_date", F.add_months("finance_month_date", F.col("back")))
    total = counted(merged(reach, ["month_date"], F.sum("charges").alias("charges"),
                           F.sum(F.when(F.col("back") == 0, F.col("charges"))).alias("own")), ["month_date"], "customer_count",
                    F.sum("charges").alias("charge_count"), F.sum("own").alias("own"))
    return total.where("own IS NOT NULL").select(
        fiscal.month_label("month_date").alias("reporting_month"), fiscal.period_start(F.add_months("month_date", 1 - span)).alias("from_day"),
        fiscal.period_end("month_date").alias("to_day"), "customer_count", "charge_count")


def month_accrual(streams: DataFrame) -> DataFrame:
    """One row per fiscal month x revenue stream x billing interval, from ``revenue_streams``.

    Only the bitmaps of ``customer_months`` are spread over the twelve months and or-ed there, so customers are shuffled
    once per month they paid in, not once per month recognised.  A charge has one fiscal month, so the charge counts of the
    months that reach into a reporting month add up.
    """
    annual = F.col("billing_interval") == ANNUAL
    spread = customer_months(streams).withColumn("month_offset", F.explode(
        F.sequence(F.lit(0), F.when(annual, SPREAD_MONTHS - 1).otherwise(0)))).withColumn(
        "reporting_month_date", F.add_months("finance_month_date", F.col("month_offset")))
    by = ["reporting_month_date", "revenue_type", "billing_interval"]
    months = counted(merged(spread, by, F.sum("cents").alias("cents"), F.sum("charges").alias("charges")), by, "customers",
                     F.sum("cents").alias("recognized_revenue_cents"), F.sum("charges").alias("charge_count"))
    return _month_accrual_columns(months.withColumns({
        "subscriber_count": F.when(F.col("revenue_type") == SUBSCRIBER, F.col("customers")),
        "reporting_month": fiscal.month_label("reporting_month_date")}))


def _month_accrual_columns(both: DataFrame) -> DataFrame:
    return both.select(
        "reporting_month",
        fiscal.period_start("reporting_month_date").alias("reporting_month_start"),
        fiscal.period_end("reporting_month_date").alias("reporting_month_end"),
        "revenue_type", "billing_interval",
        to_major("recognized_revenue_cents").alias("recognized_revenue_usd"),
        "subscriber_count", "charge_count", "recognized_revenue_cents")
