"""Fiscal calendar: months that run from the 16th to the 15th.

A timestamp or date belongs to the fiscal month keyed by a first-of-month date:
day >= cut day -> first of its own month, else first of the previous month.  The
period of key ``m`` runs from ``m + (cut-1)`` days to ``m + 1 month + (cut-2)``
days, and is labelled ``"Month YYYY"`` of ``m``.  All are plain column
expressions (whole-stage codegen, no UDF).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The fiscal cut-over day and the label pattern (English month name, year).
CUT_DAY = 16
LABEL_FORMAT = "MMMM yyyy"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fiscal_month(ts, cut_day: int = CUT_DAY) -> Column:
    """First-of-month key of the fiscal month containing ``ts`` (a UTC date)."""
    d = F.to_date(_col(ts))
    first = F.trunc(d, "MM")
    return F.when(F.dayofmonth(d) >= cut_day, first).otherwise(F.add_months(first, -1))


def next_month_rule(ts, cut_day: int = CUT_DAY) -> Column:
    """Accounting month of the prototype: day >= cut -> next month, else this month."""
    d = F.to_date(_col(ts))
    return F.trunc(F.when(F.dayofmonth(d) >= cut_day, F.add_months(d, 1)).otherwise(d), "MM")


def month_label(month) -> Column:
    return F.date_format(_col(month), LABEL_FORMAT)


def period_start(month, cut_day: int = CUT_DAY) -> Column:
    return F.date_add(_col(month), cut_day - 1)


def period_end(month, cut_day: int = CUT_DAY) -> Column:
    return F.date_add(F.add_months(_col(month), 1), cut_day - 2)


def month_from_label(label) -> Column:
    """Parse ``"Month YYYY"`` back to its first-of-month date (NULL when unparsable)."""
    return F.trunc(F.try_to_date(_col(label), LABEL_FORMAT), "MM")
