"""The three order tables derived from the star-schema tables under a data folder."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# One in so many orders is a guest's, lacks its line key, or has orphaned options.
GUEST_EVERY, CORRUPT_EVERY, ORPHAN_EVERY = 11, 1009, 997
# days around an order, and of these before it, on which a customer is looked up
LOOKUP_DAYS, LOOKUP_BACK = 61, 45
HOLIDAYS = {(1, 1): "New Year", (7, 4): "July 4", (12, 25): "Christmas"}


class Star:
    """The star-schema tables of a folder, each opened once."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def _open(self, table: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{table}.parquet")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self._open("lineitem")

    @cached_property
    def orders(self) -> DataFrame:
        return self._open("orders")

    @cached_property
    def customer(self) -> DataFrame:
        return self._open("customer")

    @cached_property
    def part(self) -> DataFrame:
        return self._open("part")


def _text(*parts: str | Column) -> Column:
    # unlike concat() never null, so that a test for null costs nothing
    return F.concat_ws("", *[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _line_id() -> Column:
    dash = "-"
    shipped = F.col("l_shipdate").cast("date")
    order, line, part, supplier = (
        F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    )
    return _text("L", order, dash, line, dash, part, dash, supplier, dash, shipped)


def order_items(star: Star) -> DataFrame:
    """Order lines, one per lineitem."""
    order_key, user = F.col("o_orderkey"), F.col("o_custkey")
    known = order_key % GUEST_EVERY != 0
    member = known & (F.col("c_mktsegment") == "BUILDING")
    corrupt = (F.col("l_orderkey") % CORRUPT_EVERY == 0) & (F.col("l_linenumber") == 1)
    # customers are found per order, not per line
    orders = star.orders.join(star.customer, user == F.col("c_custkey"))
    joined = (
        star.lineitem.join(orders, F.col("l_orderkey") == order_key)
        .join(star.part, F.col("l_partkey") == F.col("p_partkey"))
    )
    return joined.select(
        F.when(F.col("l_orderkey") % 3 == 0, "web").otherwise("mobile").alias("APP_NAME"),
        _text("R", F.col("l_suppkey")).alias("RESTAURANT_ID"),
        F.col("o_orderdate").cast("timestamp").alias("CREATION_TIME_UTC"),
        _text("O", F.col("l_orderkey")).alias("ORDER_ID"),
        F.when(known, _text("U", user)).alias("USER_ID"),
        F.when(member, _text("00", user)).alias("PRINTED_CARD_NUMBER"),
        F.when(member, "true").otherwise("false").alias("IS_LOYALTY"),
        F.lit("USD").alias("CURRENCY"),
        F.when(~corrupt, _line_id()).alias("LINEITEM_ID"),
        F.col("p_type").alias("ITEM_CATEGORY"),
        F.col("p_name").alias("ITEM_NAME"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("ITEM_PRICE"),
        F.col("l_quantity").cast("int").alias("ITEM_QUANTITY"),
    )


def order_item_options(star: Star) -> DataFrame:
    """None to three options per lineitem."""
    number = F.col("k")
    priced = (F.col("l_partkey") % 500).cast("decimal(10,2)") * F.lit("0.01").cast("decimal(3,2)")
    orphan = F.col("l_orderkey") % ORPHAN_EVERY == 0
    how_many = ((F.col("l_orderkey") + F.col("l_linenumber")) % 4).cast("int")
    return (
        star.lineitem.filter(how_many > 0)
        .withColumn("k", F.explode(F.sequence(F.lit(1), how_many)))
        .select(
            _text(F.when(orphan, "X").otherwise("O"), F.col("l_orderkey")).alias("ORDER_ID"),
            _line_id().alias("LINEITEM_ID"),
            F.when(number == 1, "size").when(number == 2, "extra").otherwise("side").alias("OPTION_GROUP_NAME"),
            _text("opt", number).alias("OPTION_NAME"),
            F.when(number == 1, priced).otherwise(0).cast("decimal(10,2)").alias("OPTION_PRICE"),
            F.lit(1).alias("OPTION_QUANTITY"),
        )
    )


def date_dim(star: Star) -> DataFrame:
    """One calendar row per order day, keys in two spellings."""
    day = F.col("d")
    short = (F.year(day) >= 2000) & (F.dayofmonth(day) % 2 == 0)
    weekday = F.date_format(day, "EEE")
    holiday = F.lit(None).cast("string")
    for (month, dom), name in HOLIDAYS.items():
        on_it = (F.month(day) == month) & (F.dayofmonth(day) == dom)
        holiday = F.when(on_it, name).otherwise(holiday)

    def flag(condition: Column) -> Column:
        return F.when(condition, "true").otherwise("false")

    days = star.orders.select(F.col("o_orderdate").cast("date").alias("d"))
    return days.distinct().select(
        F.when(short, F.date_format(day, "M/d/yy")).otherwise(F.date_format(day, "dd-MM-yyyy")).alias("date_key"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.weekofyear(day).alias("week"),
        weekday.alias("day_of_week"),
        flag(holiday.isNotNull()).alias("is_holiday"),
        flag(weekday.isin("Sat", "Sun")).alias("is_weekend"),
        holiday.alias("holiday_name"),
    )


def as_of_points(star: Star) -> DataFrame:
    """One (customer, day) to be looked up per order, some weeks around the order day."""
    day = F.col("o_orderdate").cast("date")
    shift = (F.col("o_orderkey") % LOOKUP_DAYS - LOOKUP_BACK).cast("int")
    return star.orders.select(
        _text("O", F.col("o_orderkey")).alias("ORDER_ID"), _text("U", F.col("o_custkey")).alias("USER_ID"), F.date_add(day, shift).alias("AS_OF")
    )
