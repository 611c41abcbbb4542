"""DataFrame operators on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from subledger.operators.contract import ContractError, enforce_contract
from subledger.operators.dedup import latest_per_key
from subledger.operators.joins import left_join_agg, left_join_on
from subledger.operators.pivot import pivot_measures, pivot_sum
from subledger.operators import quality as q
from subledger.operators.spread import spread_revenue


def test_latest_per_key_with_tiebreak(spark):
    df = spark.createDataFrame([(1, 10, "a"), (1, 10, "b"), (1, 5, "z"), (2, None, "x"), (2, 3, "y")],
                               "k int, t int, v string")
    out = {r.k: r.v for r in latest_per_key(df, ["k"], ["t"], ["v"]).collect()}
    assert out == {1: "b", 2: "y"}  # ties broken by v desc; NULL order sorts last


def test_latest_per_key_plans_group_limit_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = latest_per_key(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_left_join_agg_keeps_grain(spark):
    charges = spark.createDataFrame([(1,), (2,), (3,)], "charge_id int")
    refunds = spark.createDataFrame([(1, 5), (1, 7), (2, None)], "charge_id int, amt int")
    out = {r.charge_id: r.total for r in left_join_agg(charges, refunds, "charge_id",
                                                       [F.sum("amt").alias("total")]).collect()}
    assert out == {1: 12, 2: None, 3: None}


def test_left_join_on_null_keys_bypass(spark):
    left = spark.createDataFrame([(1, " A@x.com"), (2, None), (3, "b@x.com"), (4, "c@x.com")], "id int, e string")
    right = spark.createDataFrame([("a@x.com", 10), (None, 99), ("B@X.COM", 20)], "re string, v int")
    out = left_join_on(left, right, F.lower(F.trim("e")), F.lower(F.trim("re")))
    got = {r.id: r.v for r in out.collect()}
    assert got == {1: 10, 2: None, 3: 20, 4: None}
    assert out.count() == 4 and "__lk" not in out.columns


def test_pivot_sum_absent_category_is_null(spark):
    df = spark.createDataFrame([(1, "Email", 3), (1, "Email", 4), (1, "Search", None), (2, "Other", 1)],
                               "k int, cat string, v int")
    out = {r.k: (r.email, r.search) for r in pivot_sum(
        df, ["k"], pivot_measures(F.col("cat"), F.col("v"), [("email", "Email"), ("search", "Search")])).collect()}
    assert out == {1: (7, None), 2: (None, None)}


def test_spread_revenue(spark):
    df = spark.createDataFrame([(1, "annual", 6000), (2, "annual", 5999), (3, "annual", -6000),
                                (4, "monthly", 700), (5, "annual", None)], "id int, bi string, net long")
    out = spread_revenue(df, "bi", "net").collect()
    by = {}
    for r in out:
        by.setdefault(r.id, []).append((r.month_offset, r.recognized_revenue_cents))
    assert sorted(by[1]) == [(i, 500) for i in range(12)]
    assert {v for _, v in by[2]} == {500} and len(by[2]) == 12      # 59.99/12 = 4.999 -> 5.00
    assert {v for _, v in by[3]} == {-500}
    assert by[4] == [(0, 700)]
    assert len(by[5]) == 12 and {v for _, v in by[5]} == {None}
    # invariant: 12 slices within 12 x half a cent of the net
    assert abs(sum(v for _, v in by[2]) - 5999) <= 6


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a", dt.date(2024, 1, 1)), (1, None, dt.date(2024, 1, 5)),
                                (None, "b", None), (2, "z", dt.date(2024, 1, 3))], "id int, v string, d date")
    checks = q.ModelChecks("t", ("id", "v"), "id", {"v": ("a", "b")}, (("id", "id"),), ("d", 10))
    got = {(r.check, r.column): (r.failures, r.status) for r in q.check_model(df, checks, dt.date(2024, 1, 20)).collect()}
    assert got[("not_null", "id")] == (1, "fail") and got[("not_null", "v")] == (1, "fail")
    assert got[("unique", "id")] == (1, "fail")
    assert got[("accepted_values", "v")] == (1, "fail")
    assert got[("equal", "id=id")] == (0, "pass")
    assert got[("freshness", "d")] == (15, "warn")


def test_contract(spark):
    df = spark.createDataFrame([(1, "x")], "a long, b string")
    assert enforce_contract(df, [("b", "string"), ("a", "integer")]).columns == ["b", "a"]
    with pytest.raises(ContractError):
        enforce_contract(df, [("a", "string"), ("b", "string")])
    with pytest.raises(ContractError):
        enforce_contract(df, [("a", "integer")])


def test_null_keys_are_spread_across_reducers(spark):
    """A third of the rows with a NULL key must not land in one shuffle partition."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(3000).select(
            F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 100).alias("k"),
            F.col("id").alias("row"))
        right = spark.range(100).select(F.col("id").alias("rk"), (F.col("id") * 10).alias("v"))
        out = left_join_on(left, right, F.col("k"), F.col("rk"))
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert out.count() == 3000 and out.where(F.col("k").isNull() & F.col("v").isNotNull()).count() == 0
        assert max(sizes) < 1000, sizes
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_join_key_is_split_by_aqe(spark):
    """A key with a third of the many side is split across tasks by AQE's skew join
    (thresholds lowered so the small test data counts as skewed)."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        many = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997).alias("k"),
            F.col("id").alias("row"))
        dim = spark.range(997).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        out = many.join(dim, "k", "inner")
        assert out.count() == 30000
        qe = out._jdf.queryExecution()
        qe.toRdd().count()           # run this plan so AQE finalises it
        plan = qe.executedPlan().toString()
        assert "isFinalPlan=true" in plan
        assert "isSkewJoin=true" in plan or "skew=true" in plan, plan[:2000]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
