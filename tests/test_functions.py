"""Column functions on hand-made rows (fiscal calendar, money, classifiers, EWMA)."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from subledger.functions import fiscal
from subledger.plans.subscribers import subscriber_compat
from subledger.functions.classify import payer_type, resolve_interval, status_bucket
from subledger.functions.money import round_div
from subledger.functions.projection import ewma_cents, projected_cents
from subledger.functions.text import imputed_price, normalise_email, payout_label


def test_fiscal_month_edges(spark):
    rows = [(dt.datetime(2024, 3, 1),), (dt.datetime(2024, 3, 15, 23, 59),), (dt.datetime(2024, 3, 16),),
            (dt.datetime(2024, 3, 31),), (dt.datetime(2024, 1, 10),), (dt.datetime(2024, 2, 29),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    m = fiscal.fiscal_month("ts")
    out = df.select(m.alias("m"), fiscal.month_label(m).alias("label"), fiscal.period_start(m).alias("s"),
                    fiscal.period_end(m).alias("e")).collect()
    assert [r.m for r in out] == [dt.date(2024, 2, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1),
                                  dt.date(2024, 3, 1), dt.date(2023, 12, 1), dt.date(2024, 2, 1)]
    assert out[4].label == "December 2023"
    assert (out[2].s, out[2].e) == (dt.date(2024, 3, 16), dt.date(2024, 4, 15))
    assert (out[0].s, out[0].e) == (dt.date(2024, 2, 16), dt.date(2024, 3, 15))


def test_next_month_rule_and_label_roundtrip(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 16),), (dt.date(2024, 3, 15),), (dt.date(2024, 12, 20),)], "d date")
    out = df.select(fiscal.next_month_rule("d").alias("m"),
                    fiscal.month_from_label(fiscal.month_label("d")).alias("back")).collect()
    assert [r.m for r in out] == [dt.date(2024, 4, 1), dt.date(2024, 3, 1), dt.date(2025, 1, 1)]
    assert [r.back for r in out] == [dt.date(2024, 3, 1), dt.date(2024, 3, 1), dt.date(2024, 12, 1)]
    bad = spark.createDataFrame([("week 7",)], "l string").select(fiscal.month_from_label("l").alias("x"))
    assert bad.first().x is None


def _py_round_div(n, d):
    if d == 0:
        return None
    q = (2 * abs(n) + abs(d)) // (2 * abs(d))
    return q if (n >= 0) == (d > 0) or n == 0 else -q


def test_round_div_half_away_from_zero(spark):
    pairs = [(6000, 12), (5999, 12), (-6000, 12), (6, 12), (-6, 12), (18, 12), (-18, 12), (7, 0),
             (0, 5), (15, -2), (-15, -2)]
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    got = [r.q for r in df.select(round_div("n", "d").alias("q")).collect()]
    assert got == [_py_round_div(n, d) for n, d in pairs]
    assert got[:5] == [500, 500, -500, 1, -1]


def _ewma_reference(d):
    """Float formulation of the capped weighted average (for comparison)."""
    t = (sum(d) - max(d) - min(d)) / 3.0
    c = [t if x > 1.5 * t else x for x in d]
    return sum(w * x for w, x in zip((16, 8, 4, 2, 1), c)) / 31.0


def test_capped_ewma_matches_float_formula(spark):
    rng = random.Random(7)
    cases = [[rng.randint(-50000, 50000) for _ in range(5)] for _ in range(200)]
    cases += [[100, 100, 100, 100, 100], [1000, 10, 20, 30, 40], [-10, -20, -30, -40, -50], [0] * 5]
    df = spark.createDataFrame([(*c, 12345) for c in cases], "d1 long, d2 long, d3 long, d4 long, d5 long, p long")
    ds = [F.col(f"d{k}") for k in range(1, 6)]
    got = df.select(ewma_cents(ds).alias("e"), projected_cents(F.col("p"), ds).alias("pr")).collect()
    for c, r in zip(cases, got):
        exact = _ewma_reference(c)
        assert abs(r.e - exact) <= 0.5 + 1e-6
        assert abs(r.pr - (12345 + exact)) <= 0.5 + 1e-6
    # a spike above 1.5x the trimmed mean is capped
    spike = spark.createDataFrame([(1000, 10, 20, 30, 40)], "d1 long, d2 long, d3 long, d4 long, d5 long")
    e = spike.select(ewma_cents([F.col(f"d{k}") for k in range(1, 6)]).alias("e")).first().e
    assert e == round((16 * 30 + 8 * 10 + 4 * 20 + 2 * 30 + 40) / 31)


def test_ewma_null_delta_gives_null(spark):
    df = spark.createDataFrame([(1, None, 3, 4, 5)], "d1 long, d2 long, d3 long, d4 long, d5 long")
    assert df.select(ewma_cents([F.col(f"d{k}") for k in range(1, 6)]).alias("e")).first().e is None


def test_text_helpers(spark):
    df = spark.createDataFrame([("$7 a month", "  User@X.com "), ("$60.50 a year", None),
                                ("Founding plan", "a@b.c"), (None, "")], "plan string, email string")
    out = df.select(imputed_price("plan").alias("p"), normalise_email("email").alias("e")).collect()
    assert [r.p for r in out] == [7.0, 60.5, None, None]
    assert [r.e for r in out] == ["user@x.com", None, "a@b.c", ""]
    lbl = spark.createDataFrame([("Earnings from App Store subscriptions for March 2024",), ("no label",)], "d string")
    assert [r.l for r in lbl.select(payout_label("d").alias("l")).collect()] == ["March 2024", None]


def test_status_bucket_cases(spark):
    snap = dt.date(2024, 1, 10)
    mid = dt.datetime(2024, 1, 10)
    later, earlier = dt.datetime(2024, 1, 12), dt.datetime(2024, 1, 5)
    paid = dt.datetime(2023, 1, 1)
    rows = [
        (True, None, None, None, later, snap, "Active"),            # gift, not expired
        (True, None, None, None, earlier, snap, "Expired"),         # gift expired
        (True, None, None, None, None, snap, "Expired"),            # gift, NULL expiry
        (False, None, True, None, later, snap, "Active"),           # comp without payment
        (False, None, False, None, later, snap, "Non-paid"),        # never paid
        (None, None, None, None, later, snap, "Non-paid"),          # NULL booleans fall through
        (False, paid, False, earlier, later, snap, "Cancelled but Active"),
        (False, paid, False, earlier, earlier, snap, "Expired"),
        (False, paid, False, None, mid, snap, "Expired"),           # expiry = midnight of snapshot
        (False, paid, False, None, None, snap, "Expired"),
        (False, paid, False, None, later, snap, "Active"),
    ]
    df = spark.createDataFrame(rows, "g boolean, fp timestamp_ntz, c boolean, cd timestamp_ntz, "
                                     "ex timestamp_ntz, s date, want string")
    out = df.select(status_bucket("g", "fp", "c", "cd", "ex", "s").alias("b"), "want").collect()
    assert [r.b for r in out] == [r.want for r in out]


def test_payer_and_interval_classifiers(spark):
    rows = [("substack-ios-in-app-purchase", True, True, 5, "ios"), ("x", True, True, 5, "comp"),
            ("x", None, True, 5, "gift"), ("x", None, None, 5, "stripe"), (None, False, False, None, "free")]
    df = spark.createDataFrame(rows, "src string, comp boolean, gift boolean, sid long, want string")
    assert all(r.p == r.want for r in df.select(payer_type("src", "comp", "gift", "sid").alias("p"), "want").collect())
    rows = [("annual", "monthly", "x", "annual"), (None, "monthly", "yearly plan", "monthly"),
            (None, "lifetime", "$60 a Year", "annual"), (None, None, "$7 a month", "monthly"),
            (None, None, "other", None)]
    df = spark.createDataFrame(rows, "a string, b string, c string, want string")
    assert all(r.x == r.want for r in df.select(resolve_interval("a", "b", "c").alias("x"), "want").collect())
    rows = [(True, "monthly", None, None, "monthly gift"), (True, "annual", None, None, "yearly gift"),
            (False, "annual", "lifetime", None, "royalist"), (None, "monthly", None, True, "comp"),
            (None, None, None, None, "subscriber")]
    df = spark.createDataFrame(rows, "is_gift boolean, billing_interval string, subscription_interval string, is_comp boolean, want string")
    rest = "snapshot_date email start_date first_paid_date cancel_date expiration_date imputed_price_usd".split()
    daily = df.withColumns({c: F.lit(None) for c in rest}).withColumn("email", F.col("want"))
    assert all(r.type == r.email for r in subscriber_compat(daily).collect())


def test_floats_are_not_used_for_money_sums(spark):
    # 0.1 + 0.2 style drift cannot appear: sums are over integer cents
    df = spark.createDataFrame([(10,), (20,)] * 1000, "c long")
    total = df.agg(F.sum("c").alias("t")).first().t
    assert total == 30000 and not math.isnan(total)
