"""The named queries: each applies one operator to the whole tables of a data folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.functions.columns import watermark_text
from orderlake.operators import customers, enrich, history, incremental, profile, quality, sales
from orderlake.plans import views
from orderlake.schemas import LINE_KEY

# The parameters the queries are checked with.
WATERMARK = "2001-01-01T00:00:00"
REFERENCE_DATE = "2001-08-02"
SCAN_DAY = dt.date(2000, 4, 4)
AS_OF, AS_OF_LATER = "1998-06-30", "2000-06-30"
MONTH_ENDS = ("2000-03-31", "2000-06-30", "2000-09-30", "2000-12-31")
ORDER_ID = "O1"
CALENDAR_END = dt.date(2001, 7, 1)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

_MONEY = {
    "TOTAL_OPTIONS_PRICE", "LINE_REVENUE", "DAILY_SPEND", "RUNNING_LTV", "LATEST_LTV", "MONETARY",
    "TOTAL_REVENUE", "AOV", "VALUE", "LAST_SPEND", "PREVIOUS_SPEND", "SPEND_CHANGE", "TOTAL_DISCOUNT",
}


class Tables:
    """The order tables of one folder, and the silver table made from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self._star = views.Star(spark, folder)

    @cached_property
    def items(self) -> DataFrame:
        return views.order_items(self._star)

    @cached_property
    def options(self) -> DataFrame:
        return views.order_item_options(self._star)

    @cached_property
    def date_dim(self) -> DataFrame:
        return views.date_dim(self._star)

    @cached_property
    def as_of_points(self) -> DataFrame:
        return views.as_of_points(self._star)

    @cached_property
    def calendar(self) -> DataFrame:
        return enrich.parse_calendar(self.date_dim)

    @cached_property
    def valid(self) -> DataFrame:
        return quality.valid_items(self.items)

    @cached_property
    def silver(self) -> DataFrame:
        return enrich.enrich_lines(self.items, self.options)

    @property
    def all(self) -> dict[str, DataFrame]:
        return {
            "order_items": self.items,
            "order_item_options": self.options,
            "date_dim": self.date_dim,
        }

    def read(self, table: str) -> DataFrame:
        return self.all[table]


def _money(df: DataFrame) -> DataFrame:
    """Operators keep wide decimals; results carry two places at a common width."""
    return df.withColumns({c: F.col(c).cast("decimal(18,2)") for c in df.columns if c in _MONEY})


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a query under the function's name."""
    _QUERIES[build.__name__] = lambda spark, folder: _money(build(Tables(spark, folder)))
    return build


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


# --- loads -------------------------------------------------------------------------------------


@query
def scan_partition(t: Tables) -> DataFrame:
    day = incremental.on_day(t.items, "CREATION_TIME_UTC", SCAN_DAY)
    return day.select("ORDER_ID", "LINEITEM_ID", "ITEM_PRICE")


@query
def incremental_items(t: Tables) -> DataFrame:
    return incremental.select_batch("order_items", t.read, WATERMARK).select(*LINE_KEY)


@query
def incremental_options(t: Tables) -> DataFrame:
    batch = incremental.select_batch("order_item_options", t.read, WATERMARK)
    return batch.select(*LINE_KEY, "OPTION_NAME")


@query
def full_reload_dim(t: Tables) -> DataFrame:
    return incremental.select_batch("date_dim", t.read, WATERMARK).select("date_key")


@query
def batch_watermark(t: Tables) -> DataFrame:
    batch = incremental.select_batch("order_items", t.read, WATERMARK)
    highest = incremental.highest(batch, "CREATION_TIME_UTC")
    return highest.select(watermark_text("CREATION_TIME_UTC").alias("WATERMARK"))


# --- quality -----------------------------------------------------------------------------------


@query
def valid_items(t: Tables) -> DataFrame:
    return t.valid.select(*LINE_KEY)


@query
def corrupt_items(t: Tables) -> DataFrame:
    return quality.corrupt_items(t.items).select(*LINE_KEY, quality.REASON)


@query
def valid_options(t: Tables) -> DataFrame:
    return quality.valid_options(t.options, t.valid).select(*LINE_KEY, "OPTION_NAME")


@query
def orphan_options(t: Tables) -> DataFrame:
    orphans = quality.orphan_options(t.options, t.valid)
    return orphans.select(*LINE_KEY, "OPTION_NAME", quality.REASON)


@query
def quarantine_conservation(t: Tables) -> DataFrame:
    items = t.items.withColumn("VALID", F.col("LINEITEM_ID").isNotNull())
    options = quality.judged_options(t.options, t.valid)
    return quality.conservation({"order_items": (t.items, items), "order_item_options": (t.options, options)})


@query
def lines_without_options(t: Tables) -> DataFrame:
    return quality.lines_without_options(t.valid, t.options).select(*LINE_KEY)


def _order_number() -> Column:
    """The number in an order's id, after its first letter."""
    return F.substring("ORDER_ID", 2, 20).cast("bigint")


def _with_gaps(options: DataFrame) -> DataFrame:
    """Options of which some lack a price, some a quantity, and some have a negative price."""
    order = _order_number()
    price = F.when(order % 23 == 0, F.lit(None)).when(order % 29 == 0, -F.col("OPTION_PRICE")).otherwise(F.col("OPTION_PRICE"))
    return options.withColumns(
        {
            "OPTION_PRICE": price.cast("decimal(10,2)"),
            "OPTION_QUANTITY": F.when(order % 31 == 0, F.lit(None)).otherwise(F.col("OPTION_QUANTITY")),
        }
    )


@query
def corrupt_options(t: Tables) -> DataFrame:
    return quality.corrupt_options(_with_gaps(t.options)).select(*LINE_KEY, "OPTION_NAME", quality.REASON)


@query
def nonempty_keys(t: Tables) -> DataFrame:
    return quality.nonempty(t.items, "LINEITEM_ID").select(*LINE_KEY)


def _as_text(t: Tables) -> DataFrame:
    """Lines as a raw file holds them, with some values that do not fit their type."""
    order = _order_number()
    price, quantity = (F.col(c).cast("string") for c in ("ITEM_PRICE", "ITEM_QUANTITY"))
    created = F.date_format("CREATION_TIME_UTC", "yyyy-MM-dd HH:mm:ss")
    return t.items.select(
        *LINE_KEY,
        F.when(order % 13 == 0, F.concat(F.lit("$"), price)).otherwise(price).alias("ITEM_PRICE"),
        F.when(order % 17 == 0, "").otherwise(quantity).alias("ITEM_QUANTITY"),
        F.when(order % 19 == 0, "unknown").otherwise(created).alias("CREATION_TIME_UTC"),
    )


@query
def typed_projection(t: Tables) -> DataFrame:
    return enrich.typed_items(_as_text(t)).withColumn("CREATION_TIME_UTC", watermark_text("CREATION_TIME_UTC"))


@query
def unparsed_values(t: Tables) -> DataFrame:
    types = {"ITEM_PRICE": "decimal(10,2)", "ITEM_QUANTITY": "int", "CREATION_TIME_UTC": "timestamp"}
    return quality.rejected(_as_text(t), quality.unparsed(types)).select(*LINE_KEY, quality.REASON)


@query
def point_lookup(t: Tables) -> DataFrame:
    extras = enrich.roll_up_options(sales.of_order_line(t.options, ORDER_ID))
    lines = enrich.line_revenue(sales.of_order_line(t.valid, ORDER_ID), extras)
    return lines.select(*LINE_KEY, "TOTAL_OPTIONS_PRICE", "LINE_REVENUE")


@query
def day_lookup(t: Tables) -> DataFrame:
    day = sales.on_order_day(t.silver, SCAN_DAY)
    return day.select(*LINE_KEY, "ORDER_DATE", "LINE_REVENUE")


# --- profiles ----------------------------------------------------------------------------------


@query
def row_counts(t: Tables) -> DataFrame:
    return profile.row_counts(t.all)


@query
def null_profile(t: Tables) -> DataFrame:
    return profile.null_profile(t.all)


@query
def column_profile(t: Tables) -> DataFrame:
    return profile.column_profile(t.all)


@query
def duplicate_rows(t: Tables) -> DataFrame:
    return profile.duplicate_rows(t.all)


@query
def repeated_keys(t: Tables) -> DataFrame:
    return profile.repeated_keys(t.options, LINE_KEY)


@query
def loyalty_card_consistency(t: Tables) -> DataFrame:
    return profile.loyalty_card_consistency(t.items)


@query
def options_per_line(t: Tables) -> DataFrame:
    return profile.options_per_line(t.silver)


# --- silver ------------------------------------------------------------------------------------


@query
def options_rollup(t: Tables) -> DataFrame:
    # validity is a matter of the key, so the rolled-up rows are matched, not every option
    return quality.valid_options(enrich.roll_up_options(t.options), t.valid)


@query
def line_revenue(t: Tables) -> DataFrame:
    lines = enrich.line_revenue(t.valid, enrich.roll_up_options(t.options))
    return lines.select(*LINE_KEY, "LINE_REVENUE")


@query
def order_date_parts(t: Tables) -> DataFrame:
    dated = enrich.add_order_date(t.items)
    return dated.select("LINEITEM_ID", "ORDER_DATE", "year", "month", "day")


@query
def parse_date_dim(t: Tables) -> DataFrame:
    return t.calendar.select("date_key", "DATE")


@query
def order_items_enriched(t: Tables) -> DataFrame:
    return t.silver.withColumn("CREATION_TIME_UTC", watermark_text("CREATION_TIME_UTC"))


# --- customers ---------------------------------------------------------------------------------


@query
def daily_spend_ltv(t: Tables) -> DataFrame:
    return customers.daily_spend(t.silver)


@query
def customer_quintile(t: Tables) -> DataFrame:
    return customers.customer_quintile(customers.daily_spend(t.silver))


@query
def clv(t: Tables) -> DataFrame:
    return customers.customer_value(t.silver)


@query
def line_running_ltv(t: Tables) -> DataFrame:
    running = customers.line_running_value(t.silver)
    return running.select("USER_ID", "LINEITEM_ID", "ORDER_DATE", "RUNNING_LTV")


@query
def rfm(t: Tables) -> DataFrame:
    return customers.rfm(t.silver, REFERENCE_DATE)


@query
def rfm_churn(t: Tables) -> DataFrame:
    return customers.flag_churn(customers.rfm(t.silver, REFERENCE_DATE))


@query
def rfm_scores(t: Tables) -> DataFrame:
    scores = customers.rfm_scores(customers.rfm(t.silver, REFERENCE_DATE))
    return scores.select("USER_ID", "R_SCORE", "F_SCORE", "M_SCORE")


@query
def clv_as_of(t: Tables) -> DataFrame:
    return customers.value_as_of(customers.daily_spend(t.silver), AS_OF).drop("AS_OF")


@query
def clv_as_of_days(t: Tables) -> DataFrame:
    return customers.value_as_of(customers.daily_spend(t.silver), *MONTH_ENDS)


@query
def clv_as_of_points(t: Tables) -> DataFrame:
    return customers.value_at(customers.daily_spend(t.silver), t.as_of_points)


@query
def clv_latest_refund_safe(t: Tables) -> DataFrame:
    return customers.latest_value(customers.daily_spend(t.silver), refund_safe=True)


@query
def clv_tag_migration(t: Tables) -> DataFrame:
    return customers.tier_migration(customers.daily_spend(t.silver), AS_OF, AS_OF_LATER)


@query
def clv_tag_history(t: Tables) -> DataFrame:
    runs = {f"run_{i}": day for i, day in enumerate(MONTH_ENDS)}
    return history.intervals(customers.tags_on(customers.daily_spend(t.silver), runs), runs)


@query
def order_gaps(t: Tables) -> DataFrame:
    return customers.order_gaps(t.silver, REFERENCE_DATE)


@query
def spend_trend(t: Tables) -> DataFrame:
    return customers.spend_trend(t.silver, REFERENCE_DATE)


# --- sales -------------------------------------------------------------------------------------


@query
def daily_sales(t: Tables) -> DataFrame:
    return sales.daily_sales(t.silver)


@query
def location_perf(t: Tables) -> DataFrame:
    return sales.location_performance(t.silver)


@query
def top_locations(t: Tables) -> DataFrame:
    return sales.top_locations(t.silver)


@query
def location_rank(t: Tables) -> DataFrame:
    return sales.location_rank(t.silver)


@query
def location_channel(t: Tables) -> DataFrame:
    return sales.location_channel(t.silver)


@query
def order_revenue(t: Tables) -> DataFrame:
    return sales.order_revenue(t.silver)


@query
def sales_calendar(t: Tables) -> DataFrame:
    return sales.sales_calendar(t.silver, t.calendar)


@query
def sales_by_weekday(t: Tables) -> DataFrame:
    return sales.revenue_by_calendar(t.silver, t.calendar, "day_of_week")


@query
def sales_by_month(t: Tables) -> DataFrame:
    return sales.revenue_by_calendar(t.silver, t.calendar, "year", "month")


@query
def sales_by_week(t: Tables) -> DataFrame:
    return sales.revenue_by_calendar(t.silver, t.calendar, "year", "week")


@query
def sales_by_holiday(t: Tables) -> DataFrame:
    return sales.revenue_by_calendar(t.silver, t.calendar, "is_holiday", "holiday_name")


@query
def sales_by_category(t: Tables) -> DataFrame:
    return sales.revenue_by(t.silver, "ITEM_CATEGORY")


@query
def loyalty_impact(t: Tables) -> DataFrame:
    return sales.loyalty_impact(t.silver)


@query
def revenue_cube(t: Tables) -> DataFrame:
    return sales.revenue_cube(t.silver)


@query
def discounts(t: Tables) -> DataFrame:
    return sales.discounts(_with_gaps(t.options))


@query
def missing_calendar_days(t: Tables) -> DataFrame:
    # a calendar that ends before the orders do
    return sales.missing_days(t.silver, t.calendar.filter(F.col("DATE") < F.lit(CALENDAR_END)))
