"""subledger: subscription and newsletter analytics as Spark DataFrame operators.

Layout
------
- ``sources``    scans of the landing/payment tables (and the bindings that derive
                 them from the driver test tables)
- ``functions``  column-expression helpers (fiscal calendar, money, text, classifiers)
- ``operators``  DataFrame -> DataFrame building blocks (dedup, joins, pivots, spread, checks)
- ``plans``      the staging -> intermediate -> mart models composed from operators
- ``sinks``      full rebuild, view publication, partition refresh, SCD2 history
- ``streaming``  micro-batch driver for the incremental partition refresh
- ``oracle``     DuckDB SQL used to cross-check every registered query
"""

from subledger.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
