"""Money in minor units.

Amounts travel through joins, spreads and sums as integer cents (``*_cents``
columns) and become major units only at the edge of a model.  Integer sums are
exact and independent of the order partial aggregates are merged in, which a
double sum is not; rounding is done on exact integers, half away from zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    if isinstance(c, str):
        return F.col(c)
    return c if isinstance(c, Column) else F.lit(c)


def to_major(cents, scale: int = 100) -> Column:
    """Minor units -> major units as DOUBLE (one correctly rounded division)."""
    return _col(cents).cast("double") / F.lit(float(scale))


def to_minor(amount, scale: int = 100) -> Column:
    """Major units (DOUBLE with at most two decimals) -> integer minor units."""
    return F.round(_col(amount) * scale).cast("bigint")


def int_div(num, den) -> Column:
    """Exact integer quotient of a non-negative ``num`` by a positive ``den``.

    ``num - num % den`` is an exact multiple of ``den``, and dividing it as
    DECIMAL(38,0) is exact for every 64-bit value (a DOUBLE division would not be
    beyond 2^53).
    """
    n, d = _col(num), _col(den)
    exact = (n - n % d).cast("decimal(38,0)") / d.cast("decimal(38,0)")
    return exact.cast("bigint")


def round_div(num, den) -> Column:
    """``num / den`` rounded half away from zero to an integer; NULL when den is 0.

    ``den`` may be negative; both operands are integers.
    """
    n, d = _col(num).cast("bigint"), _col(den).cast("bigint")
    q = int_div(2 * F.abs(n) + F.abs(d), 2 * F.abs(d))
    negative = (n < 0) != (d < 0)
    return F.when(d == 0, F.lit(None).cast("bigint")).when(negative & (n != 0), -q).otherwise(q)
