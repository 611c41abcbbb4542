"""The landing payloads read ``events.props`` once a row, however many fields name it."""

from __future__ import annotations

import pytest

from subledger.plans import posts
from subledger.plans.catalog import Sources
from subledger.session import SESSION_CONF

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["post_overview", "post_traffic", "post_growth"])
def test_props_are_read_once_a_row(spark, name):
    landing = getattr(Sources.from_driver_tables(spark, DIR), name)
    for df in (landing, posts.post_state(landing)) if name == "post_overview" else (landing,):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("get_json_object") == 1


def test_huge_methods_are_left_to_compiled_expressions(spark):
    assert SESSION_CONF["spark.sql.codegen.hugeMethodLimit"] == "8000"
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


@pytest.mark.parametrize("name", ["post_overview", "post_traffic", "post_growth"])
def test_payloads_are_built_on_all_cores(spark, name):
    """One row group of ``events`` is one task of the scan; its payloads are built and parsed by all cores, no row lost."""
    sources = Sources.from_driver_tables(spark, DIR)
    events = spark.read.parquet(f"{DIR}/events.parquet")
    assert events.rdd.getNumPartitions() == 1
    rows = [len(part) for part in getattr(sources, name).select("post_id").rdd.glom().collect()]
    assert sum(rows) == events.count()
    assert len(rows) >= spark.sparkContext.defaultParallelism and max(rows) <= 2 * sum(rows) / len(rows)


def test_post_models_are_written_beside_the_others(spark, scratch, monkeypatch):
    """The first payment model does not wait for a post model, nor a post model for the last payment model."""
    import datetime as dt
    import threading

    from subledger.plans import build
    met, write = threading.Barrier(2), build._Run.write

    def meet(run, layer, model, *a):
        if model in ("stg_charges", "stg_post_overview"):
            met.wait(timeout=120)
        write(run, layer, model, *a)
    monkeypatch.setattr(build._Run, "write", meet)
    run = build.build_run(spark, Sources.from_driver_tables(spark, DIR), scratch, dt.date(2024, 1, 31), dt.date(2001, 6, 10),
                          checked_only=True)
    assert len(run.report_rows) == 62 and {"stg_charges", "stg_post_overview"} <= set(run.places)
