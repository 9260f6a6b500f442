"""Relations that hold between results whatever the data."""

import pytest
from pyspark.sql import functions as F

from orderlake.operators import customers, enrich, sales
from orderlake.plans.queries import Tables


@pytest.fixture(scope="module")
def silver(spark, small_data):
    frame = Tables(spark, small_data).silver.cache()
    yield frame
    frame.unpersist()


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


def test_spend_is_the_revenue_of_known_customers(silver):
    daily = customers.daily_spend(silver)
    assert total(daily, "DAILY_SPEND") == total(silver.filter("USER_ID IS NOT NULL"), "LINE_REVENUE")
    latest = customers.latest_value(daily)
    assert total(latest, "LATEST_LTV") == total(daily, "DAILY_SPEND")
    assert latest.exceptAll(customers.latest_value(daily, refund_safe=True)).isEmpty()


def test_revenue_is_the_same_however_grouped(spark, small_data, silver):
    revenue = total(silver, "LINE_REVENUE")
    assert total(sales.daily_sales(silver), "TOTAL_REVENUE") == revenue
    assert total(sales.location_performance(silver), "TOTAL_REVENUE") == revenue
    assert total(sales.order_revenue(silver), "TOTAL_REVENUE") == revenue
    cube = sales.revenue_cube(silver).filter("GROUPING_LEVEL = 7").first()
    assert cube.TOTAL_REVENUE == revenue
    calendar = enrich.parse_calendar(Tables(spark, small_data).date_dim)
    by_day = sales.revenue_by_calendar(silver, calendar, "day_of_week")
    assert total(by_day, "TOTAL_REVENUE") == revenue


def test_slices_give_the_same_reports(silver):
    slices = sales.order_slices(silver, "USER_ID", "RESTAURANT_ID", "ORDER_DATE").cache()
    for report in (
        customers.daily_spend,
        sales.daily_sales,
        sales.location_performance,
        sales.order_revenue,
        lambda df: customers.rfm(df, "2001-08-02"),
    ):
        left, right = report(silver), report(slices)
        assert left.schema.simpleString() == right.schema.simpleString()
        assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
    slices.unpersist()


def test_last_running_total_is_the_total(silver):
    running = customers.line_running_value(silver)
    highest = running.groupBy("USER_ID").agg(F.max("RUNNING_LTV").alias("v"))
    totals = silver.groupBy("USER_ID").agg(F.sum("LINE_REVENUE").alias("v"))
    assert highest.exceptAll(totals).isEmpty() and totals.exceptAll(highest).isEmpty()


@pytest.mark.parametrize("change", ["LINE_REVENUE", "CAST(7 AS DECIMAL(32,2))", "IF(USER_ID < 'U5', NULL, LINE_REVENUE)"])
def test_tagging_in_place_equals_the_join(silver, change):
    lines = silver.withColumn("LINE_REVENUE", F.expr(change).cast("decimal(32,2)"))
    daily = customers.daily_spend(lines)
    joined = customers.tag_daily(daily, customers.customer_quintile(daily))
    direct = customers.customer_value(lines)
    assert direct.columns == joined.columns
    assert direct.exceptAll(joined).isEmpty() and joined.exceptAll(direct).isEmpty()


def test_subtotals_equal_cube_and_rollup(silver):
    lines = silver.withColumn("ORDER_ID", F.expr("IF(ORDER_ID > 'O5', NULL, ORDER_ID)"))
    totals = (F.sum("LINE_REVENUE").alias("r"), F.count_distinct("ORDER_ID").alias("n"))
    level = F.grouping_id().cast("int").alias("g")
    for ours, theirs, columns in (
        (sales.revenue_cube(lines), lines.cube("IS_LOYALTY", "RESTAURANT_ID", "APP_NAME"), ["IS_LOYALTY", "RESTAURANT_ID", "APP_NAME"]),
        (sales.location_channel(lines), lines.rollup("RESTAURANT_ID", "APP_NAME"), ["RESTAURANT_ID", "APP_NAME"]),
    ):
        got = ours.select(F.col("GROUPING_LEVEL").alias("g"), *columns, "TOTAL_REVENUE", "NUM_ORDERS")
        want = theirs.agg(level, *totals).select("g", *columns, "r", "n")
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
