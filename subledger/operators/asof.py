"""As-of lookup: for each row, the latest row of the same key at or before its day.

No range join.  Both sides are laid on one time line per key and the last known row is carried forward:

1. The other side keeps its newest row per key and day (``max_by``, combined before the shuffle).
2. The time line is cut into stretches of ``stretch_days``.  What a stretch hands on to the next is one row, carried forward by a window
   that sees one row per key and stretch.
3. Within a stretch, a window runs over its days: what was handed on, the rows of each day, the days asked for.

A task of the windows thus holds at most ``2 * stretch_days + 1`` rows of a key, also where one key holds a third of
all rows: its repeated days meet before the shuffle, and its stretches go to different tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STRETCH_DAYS = 1024


def _stretch(day, stretch_days: int) -> Column:
    return F.floor(F.unix_date(day) / F.lit(stretch_days))


def latest_at_or_before(left: DataFrame, right: DataFrame, key: str, left_day: str, right_day: str,
                        order: Sequence[str] = (), one_per_key: bool = False, stretch_days: int = STRETCH_DAYS) -> DataFrame:
    """Rows of ``left`` with the columns of the right row of the same ``key`` with the greatest ``(right_day, *order)``
    among those with ``right_day <= left_day`` (inner: rows without one are left out, as are NULL keys and days).

    Days are dates.  ``order`` decides within a day (unique for a definite choice).  ``one_per_key``: the caller states that ``left``
    holds a key once; its rows then ride along instead of being joined to their answers.
    """
    found = [right_day] + [c for c in right.columns if c not in (key, right_day)]
    ordering = F.struct(*[F.col(c) for c in order]) if order else F.lit(0)
    newest = (right.where(F.col(key).isNotNull() & F.col(right_day).isNotNull())
              .groupBy(F.col(key).alias("__key"), F.col(right_day).alias("__day"))
              .agg(F.max_by(F.struct(*found), ordering).alias("__found"))
              .withColumn("__stretch", _stretch("__day", stretch_days)))
    asked = left.where(F.col(key).isNotNull() & F.col(left_day).isNotNull())
    probes = asked.select(F.col(key).alias("__key"), F.col(left_day).alias("__day"), _stretch(left_day, stretch_days).alias("__stretch"),
                          *([F.struct(*left.columns).alias("__row")] if one_per_key else []))
    if not one_per_key:
        probes = probes.distinct().withColumn("__row", F.lit(True))

    none_found = F.lit(None).cast(newest.schema["__found"].dataType)
    none_row = F.lit(None).cast(probes.schema["__row"].dataType)
    stretches = (newest.select("__key", "__stretch", "__day", "__found", F.lit(False).alias("__asked"))
                 .unionByName(probes.select("__key", "__stretch", F.lit(None).cast("date").alias("__day"),
                                            none_found.alias("__found"), F.lit(True).alias("__asked")))
                 .groupBy("__key", "__stretch").agg(F.max_by("__found", "__day").alias("__last"), F.max("__asked").alias("__asked")))
    before = Window.partitionBy("__key").orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    handed_on = (stretches.withColumn("__found", F.last("__last", ignorenulls=True).over(before))
                 .where(F.col("__asked") & F.col("__found").isNotNull()))

    line = ["__key", "__stretch", "__day", "__side", "__found", "__row"]
    events = (handed_on.withColumns({"__day": F.lit(None).cast("date"), "__side": F.lit(0), "__row": none_row}).select(*line)
              .unionByName(newest.withColumns({"__side": F.lit(0), "__row": none_row}).select(*line))
              .unionByName(probes.withColumns({"__side": F.lit(1), "__found": none_found}).select(*line)))
    along = Window.partitionBy("__key", "__stretch").orderBy(F.col("__day").asc_nulls_first(), "__side").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    answers = (events.withColumn("__found", F.last("__found", ignorenulls=True).over(along))
               .where((F.col("__side") == 1) & F.col("__found").isNotNull()))
    if one_per_key:
        return answers.select("__row.*", "__found.*")
    answers = answers.select("__key", F.col("__day").alias("__asked_day"), "__found")
    return (asked.join(answers, (asked[key] == answers["__key"]) & (asked[left_day] == answers["__asked_day"]), "inner")
            .select(*[asked[c] for c in left.columns], "__found.*"))
