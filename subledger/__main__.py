"""Command line: the three entry points of the original project.

    python -m subledger run       --source ROOT --out OUT --as-of 2024-01-31
    python -m subledger test      --source ROOT --as-of 2024-01-31
    python -m subledger freshness --source ROOT --as-of 2024-01-31

``--source`` is a folder of landing/payment Parquet tables (``charge``,
``balance_transaction``, ``refund``, ``invoice``, ``customer``, ``plan``,
``subscription_history``, ``subscription_item``, ``subscribers_snapshot``,
``post_overview``, ``post_traffic``, ``post_growth``, ``post_comments``); with
``--driver-tables`` it is a folder of the driver test tables instead.  The
cluster master and resources come from ``spark-submit``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
import uuid


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="subledger")
    p.add_argument("command", choices=["run", "test", "freshness"])
    p.add_argument("--source", required=True)
    p.add_argument("--out", help="output folder for `run` (and, if given, for the tables that `test` writes)")
    p.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    p.add_argument("--driver-tables", action="store_true")
    a = p.parse_args(argv)

    from subledger.plans.catalog import Sources
    from subledger.session import get_session
    spark = get_session()
    src = (Sources.from_driver_tables(spark, a.source) if a.driver_tables
           else Sources.from_tables(spark, a.source))

    if a.command == "run":
        if not a.out:
            p.error("run needs --out")
        from subledger.plans.build import build_all
        print(json.dumps(build_all(spark, src, a.out, a.as_of), indent=1))
        return 0

    if a.command == "test":
        from subledger.plans.build import data_checks
        from subledger.session import scratch_path
        rep = data_checks(spark, src, a.out or scratch_path(spark, f"checks-{uuid.uuid4().hex}"), a.as_of)
    else:
        from subledger.operators.quality import ModelChecks, report
        from subledger.plans.checks import LANDING_CHECKS
        from subledger.sources.statistics import newest_day
        rep = report(spark, [row for t, c in LANDING_CHECKS.items() for row in
                             ModelChecks(t, freshness=c.freshness).rows({"newest": newest_day(getattr(src, t), c.freshness[0])}, a.as_of)])
    rows = rep.collect()          # one row per declared check
    for r in rows:
        print(f"{r.status:5} {r.check:16} {r.model}.{r.column}: {r.failures}")
    return 1 if any(r.status == "fail" for r in rows) else 0


if __name__ == "__main__":
    sys.exit(main())
