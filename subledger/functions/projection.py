"""Capped weighted projection of month-over-month revenue deltas.

With deltas ``d1`` (most recent) .. ``d5`` in integer cents:

* trimmed mean ``t = (sum(d) - max(d) - min(d)) / 3``
* each ``di > 1.5 * t`` is replaced by ``t``
* ``ewma = (16 c1 + 8 c2 + 4 c3 + 2 c4 + c5) / 31``

Everything is kept exact: with ``S = sum - max - min`` the cap test is
``6 di > 3 S`` and ``93 * ewma = sum(w_i * (3 di or S))``, an integer.  Results are
rounded half away from zero to cents.  Any NULL delta makes the result NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from subledger.functions.money import round_div

# The EWMA weights (most recent first) and the outlier cap factor 1.5,
# kept as the fraction 3/2 so the cap test stays in integers.
WEIGHTS = (16, 8, 4, 2, 1)
CAP_NUM, CAP_DEN = 3, 2


def ewma_numerator(deltas: list[Column]) -> Column:
    """Integer ``3 * sum(w) * ewma`` (= 93 * ewma for the default weights)."""
    total = deltas[0]
    for d in deltas[1:]:
        total = total + d
    # greatest/least skip NULLs in Spark; the NULL sum above keeps the result NULL.
    trimmed = total - F.greatest(*deltas) - F.least(*deltas)
    num = None
    for w, d in zip(WEIGHTS, deltas):
        # d > CAP * trimmed / 3  <=>  3 * CAP_DEN * d > CAP_NUM * trimmed
        capped = F.when(3 * CAP_DEN * d > CAP_NUM * trimmed, trimmed).otherwise(3 * d)
        num = w * capped if num is None else num + w * capped
    return num


def ewma_cents(deltas: list[Column]) -> Column:
    """Capped EWMA of the deltas, rounded to whole cents."""
    return round_div(ewma_numerator(deltas), 3 * sum(WEIGHTS))


def projected_cents(prior_cents: Column, deltas: list[Column]) -> Column:
    """``round(prior + ewma)`` with the unrounded EWMA, in whole cents."""
    den = 3 * sum(WEIGHTS)
    return round_div(prior_cents * den + ewma_numerator(deltas), den)
