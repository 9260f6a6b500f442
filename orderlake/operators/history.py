"""Tiers over time: intervals in which a customer had a tier, from ``VALID_FROM`` on and before ``VALID_TO``,
which is null while the interval is open."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.functions.columns import as_date
from orderlake.operators.customers import NEW


def intervals(tags: DataFrame, days: dict[str, str | dt.date]) -> DataFrame:
    """The history that runs on the given days leave behind. ``tags`` has one row per customer and one column
    per run, named by ``days``; null where the customer had no tier on that day."""
    runs = sorted((as_date(day), name) for name, day in days.items())
    each = F.inline(F.array(*[F.struct(F.lit(day).alias("VALID_FROM"), F.col(name).alias("CLV_TAG")) for day, name in runs]))
    by_day = Window.partitionBy("USER_ID").orderBy("VALID_FROM")
    before = F.lag("CLV_TAG").over(by_day)
    changes = tags.select("USER_ID", each).withColumn("_same", F.col("CLV_TAG").eqNullSafe(before)).filter("NOT _same")
    closed = changes.withColumn("VALID_TO", F.lead("VALID_FROM").over(by_day)).filter(F.col("CLV_TAG").isNotNull())
    return closed.select("USER_ID", "CLV_TAG", "VALID_FROM", "VALID_TO")


def advance(open_: DataFrame, tags: DataFrame, day: str | dt.date) -> tuple[DataFrame, DataFrame]:
    """What a run on ``day`` does to the open intervals (USER_ID, CLV_TAG, VALID_FROM): the intervals it closes,
    and those open after it. ``tags`` has the customers' tiers on that day.

    A tier that has not changed stays open; a customer without a tier is closed. An interval opened on the same
    day is replaced and leaves nothing behind, so a run repeated with the same tiers changes nothing.
    """
    today = F.lit(as_date(day))
    now = tags.select("USER_ID", F.col("CLV_TAG").alias("_now"))
    both = open_.join(now, "USER_ID", "full")
    same = F.col("CLV_TAG").eqNullSafe(F.col("_now"))
    closed = both.filter(F.col("CLV_TAG").isNotNull() & ~same & (F.col("VALID_FROM") < today))
    still = both.filter(F.col("_now").isNotNull())
    since = F.when(same, F.col("VALID_FROM")).otherwise(today)
    return (
        closed.select("USER_ID", "CLV_TAG", "VALID_FROM", today.alias("VALID_TO")),
        still.select("USER_ID", F.col("_now").alias("CLV_TAG"), since.alias("VALID_FROM")),
    )


def valid_on(day: str | dt.date) -> Column:
    """Whether an interval holds a day."""
    day = F.lit(as_date(day))
    return (F.col("VALID_FROM") <= day) & (F.col("VALID_TO").isNull() | (F.col("VALID_TO") > day))


def migration(history: DataFrame, before: str | dt.date, after: str | dt.date) -> DataFrame:
    """Customers by tier on two days, ``New`` where a customer had none. A range condition picks the intervals
    of the two days, and both meet in one grouping by customer."""
    on = {"FROM_TAG": valid_on(before), "TO_TAG": valid_on(after)}
    tags = history.filter(reduce(Column.__or__, on.values())).groupBy("USER_ID").agg(
        *[F.coalesce(F.max(F.when(inside, F.col("CLV_TAG"))), F.lit(NEW)).alias(name) for name, inside in on.items()]
    )
    return tags.groupBy("FROM_TAG", "TO_TAG").agg(F.count(F.lit(1)).alias("CUSTOMERS"))
