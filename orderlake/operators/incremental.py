"""Selecting the rows of one load. Plain filters and semi joins, so Spark can push them down."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.columns import as_timestamp
from orderlake.operators.joins import join_unique, present
from orderlake.schemas import BY_PARENT, BY_WATERMARK, FULL_RELOAD, LOADS, LoadSpec


def newer(column: str, lo: str | dt.datetime, hi: str | dt.datetime | None = None) -> Column:
    """``lo < column <= hi``. Rows without a timestamp are never newer."""
    after = F.col(column) > F.lit(as_timestamp(lo))
    return after if hi is None else after & (F.col(column) <= F.lit(as_timestamp(hi)))


def load_spec(table: str, loads: dict[str, LoadSpec] = LOADS) -> LoadSpec:
    """The load rule of an allowed table."""
    if table not in loads:
        raise ValueError(f"no load rule for table {table!r}")
    return loads[table]


def select_batch(
    table: str,
    read: Callable[[str], DataFrame],
    lo: str | dt.datetime,
    hi: str | dt.datetime | None = None,
    loads: dict[str, LoadSpec] = LOADS,
) -> DataFrame:
    """The rows of ``table`` that belong to the load ``(lo, hi]``."""
    spec = load_spec(table, loads)
    if spec.strategy == BY_WATERMARK:
        return read(table).filter(newer(spec.watermark, lo, hi))
    if spec.strategy == BY_PARENT:
        parents = read(spec.parent).filter(newer(spec.watermark, lo, hi))
        keys = list(spec.keys)
        return read(table).join(present(parents.select(*keys), keys), keys, "left_semi")
    if spec.strategy == FULL_RELOAD:
        return read(table)
    raise ValueError(f"unknown load strategy {spec.strategy!r} for table {table!r}")


def highest(df: DataFrame, column: str) -> DataFrame:
    """One row: the largest timestamp, with microseconds kept."""
    return df.agg(F.max(column).alias(column))


def on_day(df: DataFrame, column: str, day: dt.date) -> DataFrame:
    """Rows of one UTC day, as a range on the timestamp itself so that the scan can skip data."""
    start = as_timestamp(dt.datetime.combine(day, dt.time()))
    end = start + dt.timedelta(days=1)
    return df.filter((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(end)))


def newest_per_key(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """All rows of the latest ``version`` of each key; rows repeated inside it stay repeated."""
    latest = df.groupBy(*keys).agg(F.max(version).alias(version))
    return join_unique(df, latest, [*keys, version], "left_semi", null_safe=True)
