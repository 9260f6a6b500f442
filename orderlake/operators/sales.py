"""Revenue tables. Guests are kept: their orders are revenue.

Distinct orders are counted exactly. Spark groups by (key, order) first and by key second, both with
map-side combining, so a key that holds much of the data is spread over its orders.
"""

from __future__ import annotations

import datetime as dt
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.functions.columns import as_date, per_order
from orderlake.operators.joins import join_unique
from orderlake.operators.ranking import rank_desc


def _revenue() -> Column:
    return F.sum("LINE_REVENUE").alias("TOTAL_REVENUE")


def _orders() -> Column:
    return F.count_distinct("ORDER_ID").alias("NUM_ORDERS")


def _line_count(df: DataFrame) -> Column:
    return F.sum("NUM_LINES") if "NUM_LINES" in df.columns else F.count(F.lit(1))


def order_slices(lines: DataFrame, *keep: str) -> DataFrame:
    """Lines summed to order grain within the kept columns, with the number of lines in each slice.
    Every revenue table of this module can be built from slices that keep its columns."""
    return lines.groupBy("ORDER_ID", *keep).agg(
        F.sum("LINE_REVENUE").alias("LINE_REVENUE"), _line_count(lines).alias("NUM_LINES")
    )


def revenue_by(lines: DataFrame, *columns: str | Column) -> DataFrame:
    """Revenue, distinct orders and average order value per group."""
    grouped = lines.groupBy(*columns).agg(_revenue(), _orders())
    return grouped.withColumn("AOV", per_order("TOTAL_REVENUE", "NUM_ORDERS"))


def daily_sales(lines: DataFrame) -> DataFrame:
    """Revenue, orders, lines and average order value per day."""
    grouped = lines.groupBy("ORDER_DATE").agg(
        _revenue(), _orders(), _line_count(lines).alias("NUM_LINE_ITEMS")
    )
    return grouped.withColumn("AOV", per_order("TOTAL_REVENUE", "NUM_ORDERS"))


def location_performance(lines: DataFrame) -> DataFrame:
    """Revenue, orders and average order value per restaurant."""
    return revenue_by(lines, "RESTAURANT_ID")


def order_revenue(lines: DataFrame) -> DataFrame:
    """Revenue and number of lines per order."""
    return lines.groupBy("ORDER_ID").agg(_revenue(), _line_count(lines).alias("NUM_LINE_ITEMS"))


def join_calendar(df: DataFrame, calendar: DataFrame, how: str = "inner") -> DataFrame:
    """Attach the calendar's columns by order day. ``inner`` drops days the calendar lacks."""
    return df.join(calendar, F.col("ORDER_DATE") == F.col("DATE"), how).drop("DATE")


def missing_days(lines: DataFrame, calendar: DataFrame) -> DataFrame:
    """Order days the calendar lacks, with the number of lines an inner join would drop."""
    days = lines.groupBy("ORDER_DATE").agg(F.count(F.lit(1)).alias("NUM_LINE_ITEMS"))
    known = calendar.select(F.col("DATE").alias("ORDER_DATE")).distinct()
    return join_unique(days, known, ["ORDER_DATE"], "left_anti")


def sales_calendar(lines: DataFrame, calendar: DataFrame) -> DataFrame:
    """Daily revenue with weekday and holiday flag. Summed by day before the join."""
    daily = lines.groupBy("ORDER_DATE").agg(_revenue())
    about = calendar.select("DATE", "day_of_week", "is_holiday")
    return join_calendar(daily, about)


def revenue_by_calendar(lines: DataFrame, calendar: DataFrame, *columns: str) -> DataFrame:
    """Revenue and distinct orders by calendar attributes, from lines reduced to (day, order)."""
    about = calendar.select("DATE", *columns)
    return revenue_by(join_calendar(order_slices(lines, "ORDER_DATE"), about), *columns)


def loyalty_impact(lines: DataFrame) -> DataFrame:
    """Members against others: revenue, orders, customers and average order value."""
    grouped = (
        order_slices(lines, "IS_LOYALTY", "USER_ID")
        .groupBy("IS_LOYALTY")
        .agg(_revenue(), _orders(), F.count_distinct("USER_ID").alias("NUM_CUSTOMERS"))
    )
    return grouped.withColumn("AOV", per_order("TOTAL_REVENUE", "NUM_ORDERS"))


def _revenue_over(lines: DataFrame, columns: tuple[str, ...], sets: list[tuple[str, ...]]) -> DataFrame:
    """Revenue and distinct orders for several subsets of the columns at once. A column outside the
    subset is null and sets its bit in ``GROUPING_LEVEL``, the first column's being the highest.

    Grouping sets with a distinct count would shuffle every slice once per subset. Here lines come together by
    order once. For each subset the first slice an order has in a cell is marked, which takes a sort within
    the order per chain of subsets and makes no further rows. Marks and revenue add up over the
    finest cells, and only those are summed for every subset.
    """
    kinds = dict(lines.dtypes)
    slices = order_slices(lines.repartition("ORDER_ID"), *columns)
    first = {}
    for by in _chains(columns, sets):
        for i, kept in enumerate(sets):
            if i not in first and len(kept) < len(columns) and set(by[: len(kept)]) == set(kept):
                inside = Window.partitionBy("ORDER_ID", *by[: len(kept)]).orderBy(*by[len(kept) :])
                slices = slices.withColumn(f"_row{i}", F.row_number().over(inside))
                first[i] = F.col(f"_row{i}") == 1
    marks = {i: F.col("ORDER_ID").isNotNull() & first.get(i, F.lit(True)) for i in range(len(sets))}
    finest = slices.groupBy(*columns).agg(
        F.sum("LINE_REVENUE").alias("LINE_REVENUE"), *[F.count_if(mark).alias(f"_orders{i}") for i, mark in marks.items()]
    )
    cells = [
        F.struct(
            F.lit(sum(1 << i for i, c in enumerate(reversed(columns)) if c not in kept)).alias("GROUPING_LEVEL"),
            *[(F.col(c) if c in kept else F.lit(None).cast(kinds[c])).alias(c) for c in columns],
            F.col(f"_orders{n}").alias("_orders"),
        )
        for n, kept in enumerate(sets)
    ]
    return (
        finest.select("LINE_REVENUE", F.inline(F.array(*cells)))
        .groupBy("GROUPING_LEVEL", *columns)
        .agg(_revenue(), F.sum("_orders").alias("NUM_ORDERS"))
    )


def _chains(columns: tuple[str, ...], sets: list[tuple[str, ...]]) -> list[tuple[str, ...]]:
    """Orders of the columns such that every subset is how one of them begins."""
    chains: list[tuple[str, ...]] = []
    for kept in sorted(sets, key=len, reverse=True):
        if not any(set(by[: len(kept)]) == set(kept) for by in chains):
            chains.append((*kept, *[c for c in columns if c not in kept]))
    return chains


def location_channel(lines: DataFrame) -> DataFrame:
    """Revenue by restaurant and channel with subtotals per restaurant and in total."""
    columns = ("RESTAURANT_ID", "APP_NAME")
    return _revenue_over(lines, columns, [columns[:n] for n in (2, 1, 0)])


def revenue_cube(
    lines: DataFrame, columns: tuple[str, ...] = ("IS_LOYALTY", "RESTAURANT_ID", "APP_NAME")
) -> DataFrame:
    """Revenue and distinct orders for every combination of the columns."""
    sets = [kept for n in range(len(columns) + 1) for kept in combinations(columns, n)]
    return _revenue_over(lines, columns, sets)


def location_rank(lines: DataFrame) -> DataFrame:
    """Restaurants ranked by revenue, equal revenue sharing a rank."""
    totals = lines.groupBy("RESTAURANT_ID").agg(_revenue())
    return rank_desc(totals, "TOTAL_REVENUE", "RESTAURANT_ID", "REVENUE_RANK")


def top_locations(lines: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` restaurants with most revenue."""
    best = location_performance(lines).orderBy(F.desc("TOTAL_REVENUE"), "RESTAURANT_ID")
    return best.limit(n)


def discounts(options: DataFrame) -> DataFrame:
    """Number and value of options with a negative price; zero when there are none."""
    value = F.sum(F.col("OPTION_PRICE") * F.col("OPTION_QUANTITY"))
    return options.filter(F.col("OPTION_PRICE") < 0).agg(
        F.count(F.lit(1)).alias("NUM_DISCOUNTS"),
        F.coalesce(value, F.lit(0)).alias("TOTAL_DISCOUNT"),
    )


def of_order_line(
    options: DataFrame, order_id: str, lineitem_id: str | None = None
) -> DataFrame:
    """Options of one order, or of one of its lines."""
    chosen = F.col("ORDER_ID") == order_id
    if lineitem_id is not None:
        chosen = chosen & (F.col("LINEITEM_ID") == lineitem_id)
    return options.filter(chosen)


def on_order_day(lines: DataFrame, day: str | dt.date) -> DataFrame:
    """Rows of one order day."""
    return lines.filter(F.col("ORDER_DATE") == F.lit(as_date(day)))
