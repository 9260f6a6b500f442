"""From raw lines and options to lines with revenue and business date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.columns import parse_date_key
from orderlake.operators.joins import join_unique
from orderlake.operators.quality import valid_items
from orderlake.schemas import LINE_KEY, REQUIRED_ITEM_COLUMNS


def roll_up_options(options: DataFrame, keys: list[str] = LINE_KEY) -> DataFrame:
    """One row per line: value and number of its options. Done before any join, which would
    otherwise repeat the line's own price once per option."""
    return options.groupBy(*keys).agg(
        F.sum(F.col("OPTION_PRICE") * F.col("OPTION_QUANTITY")).alias("TOTAL_OPTIONS_PRICE"),
        F.count(F.lit(1)).alias("NUM_OPTIONS"),
    )


def line_revenue(
    lines: DataFrame, options_per_line: DataFrame, keys: list[str] = LINE_KEY
) -> DataFrame:
    """Every line with its option totals and ``LINE_REVENUE``; no options count as zero."""
    return with_revenue(join_unique(lines, options_per_line, keys, "left"))


def with_revenue(lines: DataFrame) -> DataFrame:
    """``LINE_REVENUE`` of lines that carry their option totals."""
    own = F.col("ITEM_PRICE") * F.col("ITEM_QUANTITY")
    return lines.withColumn("LINE_REVENUE", own + F.coalesce(F.col("TOTAL_OPTIONS_PRICE"), F.lit(0)))


def add_order_date(df: DataFrame) -> DataFrame:
    """``ORDER_DATE`` and its ``year``, ``month`` and ``day`` from the creation time."""
    date = F.to_date("CREATION_TIME_UTC")
    return df.withColumns(
        {
            "ORDER_DATE": date,
            "year": F.year(date),
            "month": F.month(date),
            "day": F.dayofmonth(date),
        }
    )


def enrich_lines(
    items: DataFrame, options: DataFrame, required: list[str] = REQUIRED_ITEM_COLUMNS
) -> DataFrame:
    """The silver table. Orphaned options need no join of their own here: rolled up under a key that
    no valid line has, they match nothing."""
    lines = valid_items(items, required)
    return add_order_date(line_revenue(lines, roll_up_options(options)))


def parse_calendar(date_dim: DataFrame) -> DataFrame:
    """The calendar with ``DATE`` parsed from ``date_key``, null where it does not parse."""
    return date_dim.withColumn("DATE", parse_date_key("date_key"))


def typed_items(strings: DataFrame) -> DataFrame:
    """Cast text columns of order lines; text that does not fit becomes null."""
    return strings.withColumns(
        {
            "ITEM_PRICE": F.col("ITEM_PRICE").try_cast("decimal(10,2)"),
            "ITEM_QUANTITY": F.col("ITEM_QUANTITY").try_cast("int"),
            "CREATION_TIME_UTC": F.try_to_timestamp("CREATION_TIME_UTC"),
        }
    )
