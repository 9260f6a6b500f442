"""Customer tables: daily spend, lifetime value, value tiers, recency/frequency/monetary, churn.

Guests (null ``USER_ID``) belong to no customer and are left out, except in ``line_running_value``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.functions.columns import as_date
from orderlake.operators.asof import last_known
from orderlake.operators.joins import join_unique, present
from orderlake.operators.once import computed_once
from orderlake.operators.ranking import Edge, Order, tile, tile_edges, tile_number

# Tiers of the highest and lowest spend quintile, of all others, and of a customer not yet
# seen; the number of tiles; the days without an order after which a customer is gone.
HIGH, LOW, MEDIUM, NEW = "High", "Low", "Med", "New"
TILES = 5
CHURN_DAYS = 90


def _known(df: DataFrame) -> DataFrame:
    return present(df, ["USER_ID"])


def _running(df: DataFrame, spend: str, day: str) -> DataFrame:
    # one row per customer and day, so a window partition never exceeds the days of the calendar
    past = (
        Window.partitionBy("USER_ID")
        .orderBy(day)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn("RUNNING_LTV", F.sum(spend).over(past))


def daily_spend(lines: DataFrame) -> DataFrame:
    """Per customer and order day: the day's spend and the running total up to it."""
    daily = (
        _known(lines)
        .groupBy("USER_ID", F.col("ORDER_DATE").alias("SNAPSHOT_DATE"))
        .agg(F.sum("LINE_REVENUE").alias("DAILY_SPEND"))
    )
    return _running(daily, "DAILY_SPEND", "SNAPSHOT_DATE")


def latest_value(daily: DataFrame, refund_safe: bool = False) -> DataFrame:
    """Lifetime value per customer: the highest running total, or the last one if ``refund_safe``
    (they differ only where a day's spend is negative)."""
    value = F.max_by("RUNNING_LTV", "SNAPSHOT_DATE") if refund_safe else F.max("RUNNING_LTV")
    return daily.groupBy("USER_ID").agg(value.alias("LATEST_LTV"))


#: Customers by lifetime value, ties by ``USER_ID``.
SPENDING = Order("LATEST_LTV", "USER_ID")


def customer_quintile(daily: DataFrame, refund_safe: bool = False) -> DataFrame:
    """Spend quintile over all customers, 5 for the top spenders; ties go by ``USER_ID``."""
    return tile(latest_value(daily, refund_safe), TILES, SPENDING, "QUINTILE")


def tier(quintile: str = "QUINTILE") -> Column:
    """Tier name of a quintile; the three in the middle, and null, are medium."""
    return F.when(F.col(quintile) == TILES, HIGH).when(F.col(quintile) == 1, LOW).otherwise(MEDIUM)


def tag_daily(daily: DataFrame, quintiles: DataFrame) -> DataFrame:
    """Every daily row with its customer's current tier."""
    tags = quintiles.select("USER_ID", tier().alias("CLV_TAG"))
    tagged = daily.join(tags, "USER_ID", "left")
    return tagged.select("USER_ID", "SNAPSHOT_DATE", "DAILY_SPEND", "RUNNING_LTV", "CLV_TAG")


def customer_value(lines: DataFrame) -> DataFrame:
    """Daily spend, running total and tier, as ``tag_daily`` would give.

    Each daily row carries its customer's lifetime value, which shares the partitioning of the running
    total. Where the tiles begin is at most four customers, and comparing with those tags the rows in
    place: neither tiers nor daily rows are shuffled for a join.
    """
    valued = computed_once(with_latest(daily_spend(lines)), "valued")
    people = valued.groupBy("USER_ID").agg(F.max("LATEST_LTV").alias("LATEST_LTV"))
    (edges,) = tile_edges(people, TILES, [SPENDING])
    return tagged(valued, edges)


def with_latest(daily: DataFrame) -> DataFrame:
    """Daily rows with ``LATEST_LTV``, the lifetime value of their customer."""
    return daily.withColumn("LATEST_LTV", F.max("RUNNING_LTV").over(Window.partitionBy("USER_ID")))


def tagged(valued: DataFrame, edges: list[Edge]) -> DataFrame:
    """Rows that carry ``LATEST_LTV`` with the tier in its place, given where the tiles begin."""
    quintile = valued.withColumn("QUINTILE", tile_number(edges, SPENDING))
    return quintile.withColumn("CLV_TAG", tier()).drop("LATEST_LTV", "QUINTILE")


def line_running_value(lines: DataFrame) -> DataFrame:
    """Running total per customer at line grain; all lines of a day show the total after that day.
    Guests form one group.

    A window over the lines would put every guest line, or one large customer, into a single task.
    The total depends on the day alone, so it is taken over daily sums and joined back.
    """
    daily = lines.groupBy("USER_ID", "ORDER_DATE").agg(F.sum("LINE_REVENUE").alias("_spend"))
    totals = _running(daily, "_spend", "ORDER_DATE").drop("_spend")
    return join_unique(lines, totals, ["USER_ID", "ORDER_DATE"], "left", null_safe=True)


def rfm(lines: DataFrame, reference_date: str | dt.date) -> DataFrame:
    """Days since the last order, number of orders and revenue per customer. Orders after the
    reference date are not left out, so recency can be negative."""
    reference = F.lit(as_date(reference_date))
    return (
        _known(lines)
        .groupBy("USER_ID")
        .agg(
            F.count_distinct("ORDER_ID").alias("FREQUENCY"),
            F.sum("LINE_REVENUE").alias("MONETARY"),
            F.datediff(reference, F.max("ORDER_DATE")).alias("RECENCY"),
        )
    )


def flag_churn(scores: DataFrame, days: int = CHURN_DAYS) -> DataFrame:
    """``IS_CHURNED``: the last order is more than ``days`` ago."""
    return scores.withColumn("IS_CHURNED", F.col("RECENCY") > days)


def rfm_scores(scores: DataFrame) -> DataFrame:
    """Quintiles of recency, frequency and value, 5 being the best; ties go by ``USER_ID``.
    Such segments have no common definition; equal fifths per measure is the one chosen here."""
    orders = {
        "R_SCORE": Order("RECENCY", "USER_ID", descending=True),
        "F_SCORE": Order("FREQUENCY", "USER_ID"),
        "M_SCORE": Order("MONETARY", "USER_ID"),
    }
    scores = computed_once(scores, "scores")
    edges = tile_edges(scores, TILES, [*orders.values()])
    return scores.withColumns({name: tile_number(e, order) for (name, order), e in zip(orders.items(), edges)})


def value_as_of(daily: DataFrame, *days: str | dt.date) -> DataFrame:
    """Lifetime value on each of the given days, carried forward from the last order before it.
    One grouped pass serves all days; a customer without an order yet has no row for that day."""
    known = [as_date(d) for d in days]
    past = [F.when(F.col("SNAPSHOT_DATE") <= F.lit(d), F.col("SNAPSHOT_DATE")) for d in known]
    # max_by skips rows whose ordering value is null, which here are the later ones
    values = [
        F.struct(F.lit(d).alias("AS_OF"), F.max_by("RUNNING_LTV", p).alias("VALUE"), F.max(p).alias("_last"))
        for d, p in zip(known, past)
    ]
    return (
        daily.groupBy("USER_ID")
        .agg(F.array(*values).alias("_values"))
        .select("USER_ID", F.inline("_values"))
        .filter(F.col("_last").isNotNull())
        .drop("_last")
    )


def value_at(daily: DataFrame, points: DataFrame) -> DataFrame:
    """``points`` (``USER_ID``, ``AS_OF`` and others) with ``VALUE``, the lifetime value on that day, carried
    forward from the last order before it; null before the first."""
    history = daily.select("USER_ID", "SNAPSHOT_DATE", F.col("RUNNING_LTV").alias("VALUE"))
    return last_known(points, history, ["USER_ID"], "AS_OF", "SNAPSHOT_DATE", ["VALUE"])


def tags_on(daily: DataFrame, days: dict[str, str | dt.date]) -> DataFrame:
    """Per customer the tier on each of the days, in columns named by ``days``; null before the first order.
    One pass finds the values of all days; the tiers are then set by comparing, in place."""
    until = {name: F.col("SNAPSHOT_DATE") <= F.lit(as_date(day)) for name, day in days.items()}
    values = daily.groupBy("USER_ID").agg(
        *[F.max(F.when(past, F.col("RUNNING_LTV"))).alias(f"LTV_{n}") for n, past in until.items()],
        *[F.coalesce(F.bool_or(past), F.lit(False)).alias(f"IN_{n}") for n, past in until.items()],
    )
    values = computed_once(values, "values")
    orders = {name: Order(f"LTV_{name}", "USER_ID", among=f"IN_{name}") for name in days}
    edges = tile_edges(values, TILES, [*orders.values()])
    tiles = {f"TILE_{name}": tile_number(e, order) for (name, order), e in zip(orders.items(), edges)}
    tags = [F.when(F.col(f"IN_{name}"), tier(f"TILE_{name}")).alias(name) for name in days]
    return values.withColumns(tiles).select("USER_ID", *tags)


def tier_migration(daily: DataFrame, before: str | dt.date, after: str | dt.date) -> DataFrame:
    """Customers by tier on two days; ``New`` where a customer had no order yet."""
    tags = {"FROM_TAG": before, "TO_TAG": after}
    seen = tags_on(daily, tags).filter(" OR ".join(f"{name} IS NOT NULL" for name in tags))
    return seen.fillna(NEW, [*tags]).groupBy(*tags).agg(F.count(F.lit(1)).alias("CUSTOMERS"))


def order_gaps(lines: DataFrame, reference_date: str | dt.date) -> DataFrame:
    """Days since the last order and mean days between order days. The gaps between consecutive days
    add up to last minus first, so no window is needed; one order day has no gap."""
    reference = F.lit(as_date(reference_date))
    days = (
        _known(lines)
        .groupBy("USER_ID")
        .agg(
            F.min("ORDER_DATE").alias("_first"),
            F.max("ORDER_DATE").alias("_last"),
            (F.count_distinct("ORDER_DATE") - 1).alias("_gaps"),
        )
    )
    span = F.datediff("_last", "_first").cast("decimal(10,0)")
    mean = F.when(F.col("_gaps") > 0, F.round(F.try_divide(span, F.col("_gaps")), 3))
    return days.select(
        "USER_ID",
        F.datediff(reference, "_last").alias("DAYS_SINCE_LAST"),
        mean.alias("MEAN_GAP_DAYS"),
    )


def spend_trend(lines: DataFrame, reference_date: str | dt.date, days: int = 90) -> DataFrame:
    """Spend in the last ``days`` up to the reference date, in as many days before, and the change."""
    reference = F.lit(as_date(reference_date))
    age = F.datediff(reference, "ORDER_DATE")
    zero = F.lit(0)

    def spent(low: int, high: int) -> Column:
        inside = (age >= low) & (age < high)
        return F.coalesce(F.sum(F.when(inside, F.col("LINE_REVENUE"))), zero)

    return (
        _known(lines)
        .groupBy("USER_ID")
        .agg(spent(0, days).alias("LAST_SPEND"), spent(days, 2 * days).alias("PREVIOUS_SPEND"))
        .withColumn("SPEND_CHANGE", F.col("LAST_SPEND") - F.col("PREVIOUS_SPEND"))
    )
