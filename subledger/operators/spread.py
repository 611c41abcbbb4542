"""Revenue recognition spread.

An annual charge is recognised in 12 monthly slices, ``month_offset`` 0..11, each
``round(net / 12, 2)``; any other interval is one row, offset 0, full net.  The
fan-out is a generator in the same stage (no shuffle) and should sit right
before the aggregate that consumes it, after columns have been pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.functions.classify import ANNUAL
from subledger.functions.money import round_div

# Fixed value: months an annual charge is spread over.
SPREAD_MONTHS = 12


def spread_revenue(df: DataFrame, interval_col: str, net_cents_col: str,
                   out_col: str = "recognized_revenue_cents", months: int = SPREAD_MONTHS) -> DataFrame:
    annual = F.col(interval_col) == ANNUAL
    last = F.when(annual, months - 1).otherwise(0)
    return (df.withColumn("month_offset", F.explode(F.sequence(F.lit(0), last)))
              .withColumn(out_col, F.when(annual, round_div(F.col(net_cents_col), F.lit(months)))
                          .otherwise(F.col(net_cents_col))))
