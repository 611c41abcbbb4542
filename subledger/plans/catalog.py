"""Lazy catalog of models over one set of source relations.

``Models(sources)`` exposes every model as a cached attribute.  Each attribute is
a lazy DataFrame, so asking for a mart builds one logical plan spanning the
layers beneath it; nothing runs until an action.

Models read by several downstream branches (the projection mart reads
subscriptions five times and the recognised charges through four
branches) would otherwise be re-derived per branch, because each branch prunes
different columns and exchange reuse no longer applies.  With
``materialize=True`` the intermediate layer is written once as a Parquet table
under the cluster's shared ``spark.checkpoint.dir``: lineage is cut there, every
branch reads the stored result with pruning and pushdown, and a lost executor
costs a re-read, not a recomputation.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.plans import posts, projections, revenue, subscribers
from subledger.sources import bindings

SOURCE_NAMES = ("charge", "balance_transaction", "refund", "invoice", "customer", "plan",
                "subscription_history", "subscription_item", "subscribers_snapshot",
                "post_overview", "post_traffic", "post_growth", "post_comments")


class Sources:
    """Source relations by name, each produced on first use by a loader."""

    def __init__(self, loaders: dict[str, Callable[[], DataFrame]]):
        self._loaders = loaders
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self._loaders[name]()
        return self._cache[name]

    def replaced(self, name: str, df: DataFrame) -> "Sources":
        """The same sources with one relation put in the place of ``name``."""
        other = Sources(self._loaders)
        other._cache = {**self._cache, name: df}
        return other

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, root: str) -> "Sources":
        """Bindings over the driver test tables under ``root`` (one scan per table)."""
        from subledger.sources.tables import DRIVER_SCHEMAS, load
        scans: dict[str, DataFrame] = {}

        def scan(table: str) -> DataFrame:
            if table not in scans:
                scans[table] = load(spark, root, table, DRIVER_SCHEMAS.get(table))
            return scans[table]

        return cls({n: (lambda n=n: getattr(bindings, n)(spark, root, scan)) for n in SOURCE_NAMES})

    @classmethod
    def from_tables(cls, spark: SparkSession, root: str, names: dict[str, str] | None = None) -> "Sources":
        """Real landing/payment tables stored as Parquet under ``root``."""
        from subledger.sources.tables import load
        names = names or {n: n for n in SOURCE_NAMES}
        return cls({n: (lambda t=t: load(spark, root, t)) for n, t in names.items()})


class Models:
    def __init__(self, sources: Sources, materialize: bool = False, lazy: frozenset = frozenset(),
                 store: frozenset | None = None):
        self.src = sources
        self.materialize = materialize
        self.lazy = lazy          # models to keep lazy even when materializing (query targets)
        self.store = store        # models to store when materializing (None: every storable one)

    @staticmethod
    def _contract(name: str, df: DataFrame) -> DataFrame:
        """Schema-only contract check of the contracted models (no data pass)."""
        from subledger.operators.contract import enforce_contract
        from subledger.plans.contracts import CONTRACTS
        return enforce_contract(df, CONTRACTS[name])

    def _stored(self, df: DataFrame, name: str = "") -> DataFrame:
        """Write an intermediate model once as a table in the shared checkpoint
        folder and read it back (when materializing).

        Unlike ``Dataset.checkpoint`` (which computes an unpersisted plan once to
        count and again to write), the model is computed once; the Parquet copy
        gives later readers column pruning, filter pushdown and size statistics
        for join planning, and cuts lineage.
        """
        if (not self.materialize or name in self.lazy
                or (self.store is not None and name not in self.store)):
            return df
        import uuid
        from subledger.session import scratch_path
        path = scratch_path(df.sparkSession, f"models/{name or 'model'}-{uuid.uuid4().hex}")
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path)

    # staging
    @cached_property
    def stg_refunds(self): return revenue.stg_refunds(self.src.refund, self.src.balance_transaction)
    @cached_property
    def stg_charges(self):
        return self._stored(revenue.stg_charges(self.src.charge, self.src.balance_transaction,
                                                self.stg_refunds), "stg_charges")
    @cached_property
    def stg_invoices(self): return revenue.stg_invoices(self.src.invoice)
    @cached_property
    def stg_plans(self): return revenue.stg_plans(self.src.plan)
    @cached_property
    def stg_subscriptions(self): return revenue.stg_subscriptions(self.src.subscription_history)
    @cached_property
    def stg_subscription_items(self): return revenue.stg_subscription_items(self.src.subscription_item)
    @cached_property
    def stg_customers(self): return revenue.stg_customers(self.src.customer)
    @cached_property
    def stg_subscribers(self):
        return self._contract("stg_subscribers", subscribers.stg_subscribers(self.src.subscribers_snapshot))

    # intermediate
    @cached_property
    def int_subscriptions(self):
        return self._stored(revenue.int_subscriptions(
            self.current_subscriptions, self.stg_customers, self.stg_invoices, self.stg_charges),
            "int_subscriptions")
    @cached_property
    def current_subscriptions(self):
        return self._stored(revenue.current_subscriptions(
            self.stg_subscriptions, self.stg_subscription_items, self.stg_plans), "current_subscriptions")
    @cached_property
    def recognised_charges(self):
        return self._stored(revenue.recognised_charges(
            self.stg_charges, self.stg_invoices, self.current_subscriptions), "recognised_charges")
    @cached_property
    def int_charges(self):
        return self._stored(revenue.int_charges(revenue.recognised_charges(
            self.stg_charges, self.stg_invoices, self.subscription_contacts)), "int_charges")
    @cached_property
    def subscription_contacts(self):
        return revenue.subscription_contacts(self.current_subscriptions, self.stg_customers, self.stg_subscribers)
    @cached_property
    def int_payouts(self): return self._stored(revenue.int_payouts(self.stg_charges), "int_payouts")
    @cached_property
    def int_subscriber_daily(self):
        return subscribers.int_subscriber_daily(self.stg_subscribers, self.int_subscriptions)
    @cached_property
    def int_subscribers(self): return subscribers.int_subscribers(self.stg_subscribers)

    # marts
    @cached_property
    def charge_accrual(self):
        return revenue.charge_accrual(revenue.revenue_streams(self.stg_charges, self.stg_invoices, self.subscription_contacts))
    @cached_property
    def revenue_streams(self):
        return revenue.revenue_streams(self.stg_charges, self.stg_invoices, self.current_subscriptions)
    @cached_property
    def month_accrual(self): return revenue.month_accrual(self.revenue_streams)

    def month_accrual_of(self, label: str):
        """``month_accrual`` of one reporting month: only the charges that can reach it are read."""
        first, end = revenue.charge_dates_of(label)
        reach = (F.col("charged_at") >= F.lit(first)) & (F.col("charged_at") < F.lit(end))
        return revenue.month_accrual(revenue.revenue_streams(
            self.stg_charges.where(reach), self.stg_invoices, self.current_subscriptions))

    def subscriber_daily(self, as_of=None):
        return subscribers.fct_subscriber_daily(self.int_subscriber_daily, as_of)

    def revenue_projections(self, as_of):
        return projections.revenue_projections(self.subscriber_month_accrual, self.subscriber_accrual,
                                               self.current_subscriptions, as_of)

    @cached_property
    def subscriber_month_accrual(self):
        """Month roll-up of the subscriber stream only (all the projections read)."""
        return revenue.month_accrual(self.recognised_charges.withColumn("revenue_type", F.lit(revenue.SUBSCRIBER)))

    @cached_property
    def subscriber_accrual(self):
        """Charge accrual rows of the subscriber stream only."""
        return revenue.subscriber_accrual(self.recognised_charges)

    def subscriber_compat(self, as_of=None):
        return subscribers.subscriber_compat(self.subscriber_daily(as_of))

    @cached_property
    def subscriber_history(self): return subscribers.subscriber_history(self.stg_subscribers)

    # posts
    @cached_property
    def stg_post_overview(self):
        return self._stored(self._contract("stg_post_overview", posts.stg_post_overview(self.src.post_overview)),
                            "stg_post_overview")
    @cached_property
    def stg_post_traffic(self): return self._contract("stg_post_traffic", posts.stg_post_traffic(self.src.post_traffic))
    @cached_property
    def stg_post_growth(self): return self._contract("stg_post_growth", posts.stg_post_growth(self.src.post_growth))
    @cached_property
    def stg_post_comments(self): return self._contract("stg_post_comments", posts.stg_post_comments(self.src.post_comments))
    @cached_property
    def int_post_overview(self):
        return self._contract("int_post_overview", posts.int_post_overview(posts.post_state(self.src.post_overview)))
    @cached_property
    def int_post_traffic(self): return posts.latest_snapshot(self.stg_post_traffic, "post_id")
    @cached_property
    def int_post_growth(self): return posts.latest_snapshot(self.stg_post_growth, "post_id")
    @cached_property
    def int_post_comments(self): return posts.latest_snapshot(self.stg_post_comments, "comment_id")

    def projection_part(self, name: str, as_of):
        """One intermediate relation of the projection mart (for inspection and checks)."""
        win = projections.ReportingWindow.of(as_of)
        subs = self.current_subscriptions
        if name == "starts":
            return projections.historical_starts(subs)
        if name == "churn":
            return projections.churn_last_accrual(subs, self.subscriber_accrual)
        if name == "starts_revenue":
            return projections.starts_revenue(subs, self.subscriber_accrual)
        if name == "live":
            return projections.live_counters(subs, self.subscriber_accrual, win)
        actuals = projections.closed_actuals(self.subscriber_month_accrual, as_of)
        return actuals if name == "actuals" else projections.with_projection(projections.delta_history(actuals, win))
