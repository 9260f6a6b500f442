"""Values as of arbitrary days: the last one known on each day asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.operators.joins import join_unique, present

#: Days of a stretch of time; a busy key is split into stretches.
SPAN_DAYS = 90


def last_known(
    points: DataFrame, history: DataFrame, keys: list[str], at: str, since: str, columns: list[str], span_days: int = SPAN_DAYS
) -> DataFrame:
    """``points`` with the ``columns`` of the newest row of ``history`` that has the point's keys and is of its
    day ``at`` or earlier; null where there is none, or a key or the day is null. ``history`` has one row per
    keys and day ``since``. Columns of ``points`` other than keys and day are kept, whatever their names.

    Time is cut into stretches. Within a stretch the last value is found among rows of that stretch only, and
    what a stretch begins with is carried over from the last row of an earlier one. So a busy key is worked
    on by many tasks; a task sees at most the days of one stretch of it, or one row per stretch. Points are
    reduced to distinct days of a key before that, and get their values back by a join that splits hot keys.
    """
    taken = [*keys, at]
    stretch = [*keys, "_span"]

    def cut(day: str) -> Column:
        return F.floor(F.unix_date(day) / span_days)

    asked = present(points.select(*taken), taken).distinct().withColumn("_span", cut(at))
    known = present(history, [*keys, since]).select(
        *keys, F.col(since).alias(at), cut(since).alias("_span"), F.struct(*columns).alias("_value")
    )
    nothing = F.lit(None).cast(known.schema["_value"].dataType)

    lasts = known.groupBy(*stretch).agg(F.max_by("_value", at).alias("_value"), F.lit(False).alias("_asked"))
    wanted = asked.groupBy(*stretch).agg(nothing.alias("_value"), F.lit(True).alias("_asked"))
    earlier = Window.partitionBy(*keys).orderBy("_span").rangeBetween(Window.unboundedPreceding, -1)
    carried = lasts.unionByName(wanted).withColumn("_carried", F.last("_value", ignorenulls=True).over(earlier))
    carried = carried.filter("_asked").select(*stretch, "_carried")

    # of one day the value comes before the question
    inside = known.withColumn("_asked", F.lit(False)).unionByName(asked.withColumns({"_value": nothing, "_asked": F.lit(True)}))
    upto = Window.partitionBy(*stretch).orderBy(at, "_asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("_value", F.last("_value", ignorenulls=True).over(upto)).filter("_asked").drop("_asked")
    found = inside.join(carried, stretch).select(*taken, F.coalesce("_value", "_carried").alias("_value"))
    joined = join_unique(points, found, taken, "left")
    return joined.select(*points.columns, *[F.col("_value")[c].alias(c) for c in columns])
