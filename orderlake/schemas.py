"""Table schemas, keys and load rules."""

from __future__ import annotations

from dataclasses import dataclass

# Column names and types of the three source tables, as schema strings. Everything is
# nullable; missing values are set aside by the quality checks.
ORDER_ITEMS = (
    "APP_NAME string, RESTAURANT_ID string, CREATION_TIME_UTC timestamp, ORDER_ID string, "
    "USER_ID string, PRINTED_CARD_NUMBER string, IS_LOYALTY string, CURRENCY string, "
    "LINEITEM_ID string, ITEM_CATEGORY string, ITEM_NAME string, "
    "ITEM_PRICE decimal(10,2), ITEM_QUANTITY int"
)
ORDER_ITEM_OPTIONS = (
    "ORDER_ID string, LINEITEM_ID string, OPTION_GROUP_NAME string, OPTION_NAME string, "
    "OPTION_PRICE decimal(10,2), OPTION_QUANTITY int"
)
DATE_DIM = (
    "date_key string, year int, month int, week int, day_of_week string, "
    "is_holiday string, is_weekend string, holiday_name string"
)
# silver: a line with its option totals, revenue and day
ENRICHED = (
    f"{ORDER_ITEMS}, TOTAL_OPTIONS_PRICE decimal(31,2), NUM_OPTIONS bigint, "
    "LINE_REVENUE decimal(32,2), ORDER_DATE date"
)
SCHEMAS = {
    "order_items": ORDER_ITEMS,
    "order_item_options": ORDER_ITEM_OPTIONS,
    "date_dim": DATE_DIM,
}

LINE_KEY = ["ORDER_ID", "LINEITEM_ID"]
REQUIRED_ITEM_COLUMNS = ["LINEITEM_ID"]
FLOOR_WATERMARK = "1900-01-01T00:00:00"

BY_WATERMARK = "incremental_watermark"
BY_PARENT = "incremental_by_parent"
FULL_RELOAD = "full_reload"


@dataclass(frozen=True)
class LoadSpec:
    """How one source table is loaded; ``LOADS`` doubles as the list of allowed tables."""

    strategy: str
    watermark: str | None = None
    parent: str | None = None
    keys: tuple[str, ...] = ()


LOADS = {
    "order_items": LoadSpec(BY_WATERMARK, watermark="CREATION_TIME_UTC"),
    "order_item_options": LoadSpec(
        BY_PARENT, watermark="CREATION_TIME_UTC", parent="order_items", keys=tuple(LINE_KEY)
    ),
    "date_dim": LoadSpec(FULL_RELOAD),
}
