"""Accounting export prototype: USD resolution, frequency by amount, next-month rule,
recognised/deferred split.  One left join of charges to settlements on the
settlement id; the rest are row expressions in the same stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.functions import fiscal
from subledger.functions.classify import MONTHLY, interval_by_amount
from subledger.functions.money import round_div, to_major

# Fixed value: amounts below this (USD) are treated as monthly charges.
MONTHLY_THRESHOLD_CENTS = 1000


def resolve_usd(settled, settled_currency, native, native_currency, default=None):
    """Settlement in USD wins; no settlement but native USD -> native (or ``default``);
    otherwise the settlement amount."""
    fallback = native if default is None else F.lit(default)
    return (F.when(settled.isNotNull() & (settled_currency == "usd"), settled)
             .when(settled.isNull() & (native_currency == "usd"), fallback)
             .otherwise(settled))


def accounting_export(charge: DataFrame, balance_transaction: DataFrame) -> DataFrame:
    c = charge.where(F.col("status") == "succeeded").select(
        "id", F.col("created").alias("created_at"), "description", "status",
        F.col("amount").alias("amount_cents"), F.lower("currency").alias("currency"),
        "balance_transaction_id", "customer_id", F.col("receipt_email").alias("customer_email"))
    bt = balance_transaction.select(F.col("id").alias("bt_id"), F.col("amount").alias("bt_amount"),
                                    F.lower("currency").alias("bt_currency"),
                                    F.col("fee").alias("bt_fee"))
    j = c.join(bt, c.balance_transaction_id == bt.bt_id, "left")
    converted = resolve_usd(F.col("bt_amount"), F.col("bt_currency"), F.col("amount_cents"),
                            F.col("currency"))
    fee = resolve_usd(F.col("bt_fee"), F.col("bt_currency"), None, F.col("currency"), default=0)
    j = j.withColumns({"converted_cents": converted, "fee_cents": fee}).where(
        F.col("converted_cents").isNotNull())
    net = F.col("converted_cents") - F.coalesce(F.col("fee_cents"), F.lit(0))
    freq = interval_by_amount(F.col("converted_cents"), MONTHLY_THRESHOLD_CENTS)
    monthly = freq == MONTHLY
    return j.select(
        fiscal.next_month_rule("created_at").alias("accounting_month"),
        freq.alias("billing_frequency"), F.lit("charge").alias("record_type"), "id", "created_at",
        "description", to_major("amount_cents").alias("amount"), "currency",
        to_major("converted_cents").alias("converted_amount_usd"),
        F.lit("usd").alias("converted_currency"),
        to_major("fee_cents").alias("stripe_fee_usd"), F.lit(0.0).alias("substack_fee_usd"),
        to_major(F.coalesce(F.col("fee_cents"), F.lit(0))).alias("total_fees_usd"),
        to_major(net).alias("net_total_usd"),
        to_major(F.when(monthly, net).otherwise(round_div(net, 12))).alias("recognized_net_usd"),
        to_major(F.when(monthly, F.lit(0)).otherwise(round_div(net * 11, 12)))
        .alias("deferred_net_usd_initial"),
        F.lit(None).cast("double").alias("tax_liability_usd"),
        "customer_id", "customer_email", "balance_transaction_id")
