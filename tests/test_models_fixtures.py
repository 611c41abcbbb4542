"""Models on small hand-made inputs covering the edge rows of the fixture plan."""

import datetime as dt
import json

from pyspark.sql import functions as F

from subledger.plans import posts, projections, revenue
from subledger.plans.projections import ReportingWindow

TS = "timestamp_ntz"


def test_net_of_refunds(spark):
    charge = spark.createDataFrame([
        (1, 1, None, 10, dt.datetime(2024, 1, 5), 1000, "USD", None, None, "succeeded"),
        (2, 1, None, 20, dt.datetime(2024, 1, 5), 1000, "eur", None, None, "failed"),
        (3, 1, None, 30, dt.datetime(2024, 1, 5), 1000, "usd", None, None, "succeeded"),   # no settlement
        (4, 1, None, 40, dt.datetime(2024, 1, 5), 1000, "usd", None, None, "succeeded"),   # two refunds
        (5, 1, None, 50, dt.datetime(2024, 1, 5), 1000, "usd", None, None, "succeeded"),   # refund w/o settlement
    ], f"id long, customer_id long, invoice_id long, balance_transaction_id long, created {TS}, amount long, "
       "currency string, receipt_email string, description string, status string")
    bt = spark.createDataFrame([(10, 1000, 59, 941), (20, 1000, 59, 941), (40, 1000, 59, 941),
                                (41, -100, 0, -100), (42, -200, 0, -200), (50, 1000, 59, 941),
                                (31, -50, 0, -50)], "id long, amount long, fee long, net long")
    bt = bt.withColumn("exchange_rate", F.lit(None).cast("double"))
    refund = spark.createDataFrame([(1, 4, 41, dt.datetime(2024, 1, 6), "succeeded"),
                                    (2, 4, 42, dt.datetime(2024, 1, 7), "succeeded"),
                                    (3, 4, 43, dt.datetime(2024, 1, 7), "pending"),
                                    (4, 5, 99, dt.datetime(2024, 1, 7), "succeeded"),
                                    (5, 3, 31, dt.datetime(2024, 1, 7), "succeeded")],
                                   f"id long, charge_id long, balance_transaction_id long, created {TS}, status string")
    out = {r.charge_id: r for r in revenue.stg_charges(charge, bt, revenue.stg_refunds(refund, bt)).collect()}
    assert set(out) == {1, 3, 4, 5}
    assert out[1].net_amount_usd == 9.41 and out[1].charge_currency == "usd"
    assert out[3].net_amount_usd is None            # settlement missing => NULL even with a refund
    assert out[4].net_amount_cents == 941 - 300     # two refunds, pending one ignored
    assert out[5].net_amount_cents == 941           # refund without settlement counts as 0


def test_payouts(spark):
    rows = [(1, "Earnings from App Store subscriptions for March 2024", dt.datetime(2024, 4, 20)),
            (2, "Earnings from App Store subscriptions for week 7", dt.datetime(2024, 4, 10)),
            (3, "Earnings from App Store subscription fees", dt.datetime(2024, 4, 10)),
            (4, None, dt.datetime(2024, 4, 10))]
    charges = spark.createDataFrame(rows, f"charge_id long, description string, charged_at {TS}")
    charges = charges.withColumns({"settled_amount_usd": F.lit(1.0), "net_amount_usd": F.lit(1.0),
                                   "charge_currency": F.lit("usd"), "net_amount_cents": F.lit(100).cast("long")})
    out = {r.charge_id: r for r in revenue.int_payouts(charges).collect()}
    assert set(out) == {1, 2}
    assert out[1].payout_month_label == "March 2024" and out[1].reporting_month == "April 2024"
    assert out[2].reporting_month == "March 2024" and out[2].reporting_month_start == dt.date(2024, 3, 16)


def _accrual(spark, series):
    """Monthly subscriber accrual rows from {interval: [revenue cents ...]}."""
    rows = []
    for interval, revs in series.items():
        m = dt.date(2023, 1, 1)
        for rev in revs:
            start, end = m + dt.timedelta(days=15), (m.replace(day=28) + dt.timedelta(days=4)).replace(day=1) + dt.timedelta(days=14)
            rows.append((m.strftime("%B %Y"), start, end, "subscriber", interval, rev, 10, 10))
            m = (m.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    return spark.createDataFrame(rows, "reporting_month string, reporting_month_start date, "
                                       "reporting_month_end date, revenue_type string, billing_interval string, "
                                       "recognized_revenue_cents long, subscriber_count long, charge_count long")


def test_delta_history_thresholds(spark):
    acc = _accrual(spark, {"a5": [100] * 5, "a6": [100, 200, 300, 400, 500, 600],
                           "a7": [100, 200, 300, 400, 500, 600, 700], "a9": list(range(100, 1000, 100))})
    win = ReportingWindow.of(dt.date(2024, 6, 20))
    hist = projections.delta_history(projections.closed_actuals(acc, win.as_of), win).collect()
    closed = {r.billing_interval for r in hist if r.row_type == "closed"}
    live = {r.billing_interval for r in hist if r.row_type == "live"}
    assert closed == {"a7", "a9"} and live == {"a6", "a7", "a9"}
    assert sum(1 for r in hist if r.row_type == "closed" and r.billing_interval == "a9") == 3


def test_reporting_window():
    w = ReportingWindow.of(dt.date(2024, 3, 10))
    assert (w.label, w.start, w.end, w.total_days, w.elapsed_days) == (
        "February 2024", dt.date(2024, 2, 16), dt.date(2024, 3, 15), 29, 24)


def _overview_row(spark, data):
    return spark.createDataFrame([(1, "p", dt.datetime(2024, 1, 1), data)],
                                 f"post_id long, publication string, snapshot_date {TS}, data string")


def test_overview_strict_json(spark):
    payload = {"posts": [{"id": 1, "title": 5, "is_published": "true", "comment_count": 3,
                          "stats": {"sent": "12", "delivered": 10.5, "opened": 7, "open_rate": 1,
                                    "referrers": {"total_views": 9}, "comps": {"avg_views": 2.5}},
                          "post_date": "2024-01-02 03:04:05"}]}
    r = posts.stg_post_overview(_overview_row(spark, json.dumps(payload))).first()
    assert r.post_id_check == 1 and r.title is None and r.is_published is None
    assert r.sent is None and r.delivered is None and r.opened == 7 and r.open_rate == 1.0
    assert r.referrer_total_views == 9 and r.pub_avg_views == 2.5 and r.author_name is None
    assert r.post_date == dt.datetime(2024, 1, 2, 3, 4, 5)
    empty = posts.stg_post_overview(_overview_row(spark, '{"posts": []}')).first()
    assert empty.post_id_check is None and empty.post_id == 1


def test_last_known_metrics(spark):
    rows = [(1, "p", dt.datetime(2024, 1, d), json.dumps({"posts": [{"stats": s}]}))
            for d, s in [(1, {"likes": 5, "engaged": 1, "data_updated_at": 1704067200000}),
                         (2, {"likes": None, "engaged": 2}), (3, {"views": 9})]]
    df = spark.createDataFrame(rows, f"post_id long, publication string, snapshot_date {TS}, data string")
    r = posts.int_post_overview(posts.post_state(df)).first()
    assert r.snapshot_date == dt.datetime(2024, 1, 3) and r.views == 9
    assert r.likes == 5 and r.engaged == 2
    assert r.stats_updated_at == dt.datetime(2024, 1, 1)


def test_traffic_pivot(spark):
    full = {"referrers": [{"source_category": "Email", "views": 3, "paid_subscriber_views": "2"},
                          {"source_category": "Email", "views": "4"},
                          {"source_category": "Podcast", "views": 100}],
            "devices": [{"device_type": "Email", "views": 1}],
            "categories": [{"category_type": "Search", "category_views": "1.5"}]}
    missing = {"referrers": [{"source_category": "Email", "views": 1}], "categories": [{"category_type": "Email"}]}
    empty = dict(full, devices=[])
    rows = [(1, "p", dt.datetime(2024, 1, 1), json.dumps(full)), (2, "p", dt.datetime(2024, 1, 1), json.dumps(missing)),
            (3, "p", dt.datetime(2024, 1, 1), json.dumps(empty))]
    df = spark.createDataFrame(rows, f"post_id long, publication string, snapshot_date {TS}, data string")
    out = posts.stg_post_traffic(df).collect()
    assert [r.post_id for r in out] == [1]
    r = out[0]
    assert r.referrer_views_email == 7 and r.paid_views_email == 2 and r.referrer_views_search is None
    assert r.device_views_email == 1 and r.category_views_search is None


def test_growth_lenient(spark):
    payload = {"subscribes": {"totals": {"subscribes": 3, "monthly_subscribes": "4", "annual_subscribes": "1.5",
                                         "founding_subscribes": {"n": 1}}}, "signups": {"total": 2}}
    df = spark.createDataFrame([(1, "p", dt.datetime(2024, 1, 1), json.dumps(payload))],
                               f"post_id long, publication string, snapshot_date {TS}, data string")
    r = posts.stg_post_growth(df).first()
    assert (r.subscribes, r.monthly_subscribes, r.annual_subscribes, r.founding_subscribes, r.signups,
            r.unsubscribes) == (3, 4, None, None, 2, None)
