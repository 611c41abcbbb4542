"""Property tests against exact rational references (hypothesis-generated inputs)."""

import datetime as dt
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from subledger.functions import fiscal
from subledger.functions.money import round_div
from subledger.functions.projection import ewma_cents, projected_cents


def _half_away(q: Fraction) -> int:
    n = abs(q)
    r = int(n + Fraction(1, 2)) if (n - int(n)) >= Fraction(1, 2) else int(n)
    return r if q >= 0 else -r


def _fiscal_month(d: dt.date) -> dt.date:
    first = d.replace(day=1)
    return first if d.day >= 16 else (first - dt.timedelta(days=1)).replace(day=1)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dates(dt.date(1990, 1, 1), dt.date(2040, 12, 31)), min_size=50, max_size=200))
def test_fiscal_month_matches_rule(spark, dates):
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    got = [r.m for r in df.select(fiscal.fiscal_month("d").alias("m")).collect()]
    assert got == [_fiscal_month(d) for d in dates]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-2**60, 2**60), st.integers(-10**6, 10**6)), min_size=50, max_size=200))
def test_round_div_is_exact(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r.q for r in df.select(round_div("n", "d").alias("q")).collect()]
    want = [None if d == 0 else _half_away(Fraction(n, d)) for n, d in pairs]
    assert got == want


def _exact_ewma(ds):
    t = Fraction(sum(ds) - max(ds) - min(ds), 3)
    capped = [t if Fraction(x) > Fraction(3, 2) * t else Fraction(x) for x in ds]
    return sum(w * c for w, c in zip((16, 8, 4, 2, 1), capped)) / 31


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(*[st.integers(-10**8, 10**8)] * 5, st.integers(0, 10**10)), min_size=50, max_size=200))
def test_capped_ewma_is_exact(spark, rows):
    df = spark.createDataFrame(rows, "d1 long, d2 long, d3 long, d4 long, d5 long, p long")
    ds = [F.col(f"d{k}") for k in range(1, 6)]
    got = df.select(ewma_cents(ds).alias("e"), projected_cents(F.col("p"), ds).alias("pr")).collect()
    for row, r in zip(rows, got):
        e = _exact_ewma(row[:5])
        assert r.e == _half_away(e)
        assert r.pr == _half_away(row[5] + e)
