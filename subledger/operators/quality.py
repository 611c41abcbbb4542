"""Declarative data checks, counted while a model is written.

A ``ModelChecks`` names what a model must hold.  ``observed`` puts its counts on the model as observed metrics, so that the job
that writes the model counts them on the way: a declared check costs no pass.  Uniqueness needs values to meet; it is read
from the key column of the written table alone, with partial counts per task before the shuffle, so a repeated value that a third of
all rows hold costs one row per task.

Metrics of a stage that is run again after a lost executor may count a row twice; a check that passes stays at 0, and none is missed.
Reports have the columns ``check``, ``model``, ``column``, ``failures``, ``status``, a row per declared check.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

REPORT_SCHEMA = "check string, model string, `column` string, failures long, status string"
REPORT_COLUMNS = ["check", "model", "column", "failures", "status"]


@dataclass(frozen=True)
class ModelChecks:
    """Declared checks of one model.  ``equal`` is a warning; ``freshness`` is ``(column, warn_after_days)``."""

    model: str
    not_null: tuple[str, ...] = ()
    unique: str | None = None
    accepted: dict[str, tuple] = field(default_factory=dict)
    equal: tuple[tuple[str, str], ...] = ()
    freshness: tuple[str, int] | None = None

    def conditions(self) -> dict[tuple[str, str], Column]:
        """(check, column) -> what a failing row looks like."""
        bad = {("not_null", c): F.col(c).isNull() for c in self.not_null}
        bad |= {("accepted_values", c): ~F.col(c).isin(*values) for c, values in self.accepted.items()}
        return bad | {("equal", f"{a}={b}"): ~F.col(a).eqNullSafe(F.col(b)) for a, b in self.equal}

    def observed(self, df: DataFrame) -> tuple[DataFrame, Observation]:
        """``df`` with the counts as metrics of whichever job runs it next."""
        counts = [F.count_if(c).alias(f"m{i}") for i, c in enumerate(self.conditions().values())]
        if self.freshness:
            counts.append(F.to_date(F.max(self.freshness[0])).alias("newest"))
        seen = Observation()
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen

    def rows(self, metrics: dict, as_of: dt.date, repeated: int | None = None) -> list[tuple]:
        """Report rows from the metrics of a finished job."""
        out = []
        for i, (check, column) in enumerate(self.conditions()):
            n = metrics.get(f"m{i}") or 0
            out.append((check, self.model, column, n, "pass" if n == 0 else "warn" if check == "equal" else "fail"))
        if self.unique:
            out.append(("unique", self.model, self.unique, repeated, "pass" if repeated == 0 else "fail"))
        if self.freshness:
            column, days = self.freshness
            newest = metrics.get("newest")
            age = None if newest is None else (as_of - newest).days
            out.append(("freshness", self.model, column, age, "warn" if age is None or age > days else "pass"))
        return out


def repeated_values(df: DataFrame, column: str) -> int:
    """Number of non-NULL values of ``column`` that occur more than once."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).count()
    return counts.where(F.col("count") > 1).count()


def report(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """One row per declared check."""
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def check_model(df: DataFrame, checks: ModelChecks, as_of: dt.date) -> DataFrame:
    """The checks of a relation that nobody writes: one pass that counts, one over the key where it must be unique."""
    seen, metrics = checks.observed(df)
    seen.write.format("noop").mode("overwrite").save()
    repeated = repeated_values(df, checks.unique) if checks.unique else None
    return report(df.sparkSession, checks.rows(metrics.get, as_of, repeated))
