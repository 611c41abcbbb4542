"""Build every model as a table: the staging -> intermediate -> mart run.

Each model is written once under ``out_root/<layer>/<model>`` and read back by later ones, in dependency order; the declared
checks are counted by the jobs that write (``operators.quality``), those of a landing table by the job of the staging model that reads
it.  Full rebuilds are version folders; the daily subscriber models are partitioned by day and refreshed; the legacy view
is a stored definition; the subscriber history rewrites only the key buckets that changed.  A failed run leaves the previous
tables in place.

The post models and the others read nothing of each other: the two branches are written side by side, so that the last tasks of
a job in one leave no core idle while the other has work.
"""

from __future__ import annotations

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from subledger.operators import quality
from subledger.plans import projections, subscribers
from subledger.plans.catalog import Models, Sources
from subledger.plans.checks import LANDING_CHECKS, LANDING_READ_BY, MODEL_CHECKS
from subledger.sinks.history import BucketedHistory
from subledger.sinks.tables import publish_view, read_days, read_table, refresh_partitions, write_full

LAYERS = {
    "staging": ["stg_refunds", "stg_charges", "stg_invoices", "stg_plans", "stg_subscriptions",
                "stg_subscription_items", "stg_customers", "stg_subscribers", "stg_post_overview",
                "stg_post_traffic", "stg_post_growth", "stg_post_comments"],
    "intermediate": ["current_subscriptions", "subscription_contacts", "int_subscriptions", "int_charges", "int_payouts",
                     "int_subscribers", "int_post_overview", "int_post_traffic", "int_post_growth",
                     "int_post_comments"],
    "mart": ["charge_accrual", "month_accrual"],
}
#: Marts that publish an intermediate model as it is.
PUBLISHED_POSTS = {f"post_{kind}": f"int_post_{kind}" for kind in ("overview", "traffic", "growth", "comments")}
HISTORY_KEY, HISTORY_WATCHED, HISTORY_STAMP = "subscription_id", ["cancel_date"], "snapshot_date"


class _Run(Models):
    """Models whose attributes resolve to tables already written by this run, and what their writes have counted."""

    def __init__(self, spark: SparkSession, sources: Sources, out_root: str, as_of: dt.date):
        super().__init__(sources)
        self.spark, self.root, self.as_of = spark, out_root, as_of
        self.places: dict[str, str] = {}
        self.report_rows: list[tuple] = []
        self._landing = {model: table for table, model in LANDING_READ_BY.items()}

    def _watch_landing(self, name: str):
        """Let the write of a staging model count the checks of the landing table that it reads."""
        table = self._landing.get(name)
        if table is None:
            return None
        df, metrics = LANDING_CHECKS[table].observed(getattr(self.src, table))
        self.src = self.src.replaced(table, df)
        return LANDING_CHECKS[table], metrics

    def _counted(self, name: str, write) -> None:
        """Run ``write`` with a function that puts the model's checks on what it writes, and report what they counted."""
        checks, seen = MODEL_CHECKS.get(name), []

        def observed(df: DataFrame) -> DataFrame:
            if checks is None:
                return df
            df, metrics = checks.observed(df)
            seen.append(metrics)
            return df

        write(observed)
        if checks:
            repeated = quality.repeated_values(self.table(name), checks.unique) if checks.unique else None
            self.report_rows += checks.rows(seen[-1].get, self.as_of, repeated)

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.places[name])

    def write(self, layer: str, name: str, df: DataFrame | None = None) -> None:
        original, watched = self.src, self._watch_landing(name)
        self.places[name] = os.path.join(self.root, layer, name)
        model = getattr(self, name) if df is None else df
        self._counted(name, lambda observed: write_full(observed(model), self.places[name]))
        self.src = original
        if watched:
            self.report_rows += watched[0].rows(watched[1].get, self.as_of)
        self.__dict__[name] = self.table(name)      # later models read the table, not the plan

    def refresh(self, layer: str, name: str, upstream: DataFrame, build=None) -> None:
        """A model partitioned by day: the look-back days are replaced, and checked."""
        self.places[name] = path = os.path.join(self.root, layer, name)
        self._counted(name, lambda observed: refresh_partitions(
            upstream, path, self.as_of, build=lambda days: observed(build(days) if build else days)))
        self.__dict__[name] = read_days(self.spark, path)


    def write_layers(self, names) -> None:
        for layer, models in LAYERS.items():
            for name in models:
                if name in names:
                    self.write(layer, name)

    def adopt(self, other: "_Run") -> None:
        """Take over the tables and the report of another branch of the same run."""
        self.places |= other.places
        self.report_rows += other.report_rows
        self.__dict__.update({name: self.table(name) for name in other.places})


#: The branch of the models over the post landing tables.
POST_MODELS = {name for names in LAYERS.values() for name in names if "_post_" in name}
#: Models without a declared check that no checked model reads.
UNCHECKED = {"int_subscribers", "int_post_traffic", "int_post_growth", "int_post_comments"}


def build_run(spark: SparkSession, sources: Sources, out_root: str, as_of: dt.date, revenue_as_of: dt.date | None = None,
              checked_only: bool = False) -> _Run:
    """Run every model.  ``revenue_as_of``: the run date of the projections, if it is another; ``checked_only``: only models with
    declared checks and what they are built from."""
    m, posts = (_Run(spark, sources, out_root, as_of) for _ in range(2))
    names = {name for models in LAYERS.values() for name in models} - (UNCHECKED if checked_only else set())
    with ThreadPoolExecutor(1) as pool:
        branch = pool.submit(inheritable_thread_target(spark)(posts.write_layers), names & POST_MODELS)
        m.write_layers(names - POST_MODELS)
        m.write("mart", "revenue_projections", projections.revenue_projections(
            m.month_accrual, m.charge_accrual, m.current_subscriptions, revenue_as_of or as_of))

        m.refresh("intermediate", "int_subscriber_daily", m.int_subscriber_daily)
        m.refresh("mart", "subscriber_daily", m.int_subscriber_daily, subscribers.fct_subscriber_daily)
        branch.result()
    m.adopt(posts)
    if checked_only:
        return m
    for name, source in PUBLISHED_POSTS.items():
        m.write("mart", name, getattr(m, source))
    m.places["subscriber_compat"] = publish_view(spark, out_root, "subscriber_compat", subscribers.COMPAT_SQL,
                                                 {"daily": "mart/subscriber_daily"})

    # snapshot history: apply today's latest subscriber list to the stored history
    m.places["subscriber_history"] = place = os.path.join(out_root, "snapshots", "subscriber_history")
    BucketedHistory(spark, place, HISTORY_KEY, HISTORY_WATCHED, HISTORY_STAMP).merge(m.int_subscribers)
    return m


def build_all(spark: SparkSession, sources: Sources, out_root: str, as_of: dt.date) -> dict[str, str]:
    """Run every model; returns ``{model: location}``, the report of the declared checks included."""
    m = build_run(spark, sources, out_root, as_of)
    m.places["data_checks"] = os.path.join(out_root, "checks")
    write_full(quality.report(spark, m.report_rows).coalesce(1), m.places["data_checks"])
    return m.places


def data_checks(spark: SparkSession, sources: Sources, out_root: str, as_of: dt.date, revenue_as_of: dt.date | None = None) -> DataFrame:
    """The report of the declared checks of one run under ``out_root``."""
    return quality.report(spark, build_run(spark, sources, out_root, as_of, revenue_as_of, checked_only=True).report_rows)
