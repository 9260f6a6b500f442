"""Column expressions shared by the operators. All run inside generated code; there are no UDFs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two spellings of a calendar key, tried in this order.
DATE_KEY_FORMATS = ("dd-MM-yyyy", "M/d/yy")


def parse_date_key(key: str | Column) -> Column:
    """Date of a calendar key in either spelling, null if it fits neither."""
    return F.coalesce(*[F.try_to_date(key, fmt) for fmt in DATE_KEY_FORMATS])


def per_order(revenue: str, orders: str) -> Column:
    """Average order value to two places; null without orders."""
    return F.round(F.try_divide(F.col(revenue), F.col(orders)), 2)


def as_date(value: str | dt.date) -> dt.date:
    """Check a date argument on the driver instead of failing inside tasks."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


def as_timestamp(value: str | dt.datetime) -> dt.datetime:
    """Check a watermark argument; a naive value is taken as UTC."""
    stamp = value if isinstance(value, dt.datetime) else dt.datetime.fromisoformat(value)
    return stamp if stamp.tzinfo else stamp.replace(tzinfo=dt.timezone.utc)


def watermark_text(column: str | Column) -> Column:
    """Fixed-width ISO text of a timestamp, microseconds kept, so text order is time order."""
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
