"""Small hand-made tables."""

import datetime as dt
from decimal import Decimal

from orderlake.schemas import DATE_DIM, ORDER_ITEM_OPTIONS, ORDER_ITEMS


def items(spark, rows):
    """Order lines from (line, order, user, time, price, quantity) tuples."""
    full = [
        ("web", "R1", _time(time), order, user, None, "false", "USD", line, "food", "soup", _money(price), quantity)
        for line, order, user, time, price, quantity in rows
    ]
    return spark.createDataFrame(full, ORDER_ITEMS)


def options(spark, rows):
    """Options from (order, line, name, price, quantity) tuples."""
    full = [(o, line, "extra", name, _money(price), quantity) for o, line, name, price, quantity in rows]
    return spark.createDataFrame(full, ORDER_ITEM_OPTIONS)


def calendar(spark, keys):
    return spark.createDataFrame([(k, 2024, 1, 1, "Mon", "false", "false", None) for k in keys], DATE_DIM)


def lines(spark, rows, schema):
    """Enriched lines with money columns given as numbers."""
    return spark.createDataFrame([tuple(_cell(v) for v in row) for row in rows], schema)


def day(text):
    return dt.date.fromisoformat(text)


def _time(text):
    return None if text is None else dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def _money(value):
    return None if value is None else Decimal(str(value))


def _cell(value):
    return Decimal(str(value)) if isinstance(value, float) else value


def by(df, *keys):
    """Rows as dicts, by key."""
    rows = [r.asDict() for r in df.collect()]
    return {(r[keys[0]] if len(keys) == 1 else tuple(r[k] for k in keys)): r for r in rows}
