"""Parquet and database sinks. Overwrite modes are set per write, never on the session."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.columns import as_date

DAY_PARTS = ("year", "month", "day")


def replace_table(df: DataFrame, path: str) -> str:
    """Replace a whole unpartitioned table."""
    df.write.mode("overwrite").parquet(path)
    return path


def replace_partitions(df: DataFrame, path: str, columns: tuple[str, ...] = DAY_PARTS) -> str:
    """Replace only the partitions that occur in ``df``.

    The rebalance brings a partition's rows together, so that few files are written, and lets AQE cut
    a partition far larger than the others over several tasks.
    """
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )
    return path


def write_partitions(df: DataFrame, path: str, columns: tuple[str, ...]) -> str:
    """Replace a whole table, one folder per value of the columns, rows brought together as above."""
    whole = df.hint("rebalance", *columns).write.mode("overwrite").option("partitionOverwriteMode", "static")
    whole.partitionBy(*columns).parquet(path)
    return path


def write_raw_day(df: DataFrame, root: str, table: str, load_date: str | dt.date) -> str:
    """Stamp the load date and replace that date's partition of a raw table."""
    stamped = df.withColumn("load_date", F.lit(as_date(load_date)))
    return replace_partitions(stamped, f"{root}/{table}", ("load_date",))


def append_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Append to a database table; ``numPartitions`` bounds the connections."""
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()
