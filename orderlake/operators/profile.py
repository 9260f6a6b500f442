"""Table profiles: row counts, nulls, repeated keys and rows, distinct values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, counted table by table before they meet."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("NUM_ROWS")).select(F.lit(t).alias("TABLE_NAME"), "NUM_ROWS")
        for t, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def null_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Nulls per table and column; one pass over each table."""

    def nulls(table: str, df: DataFrame) -> DataFrame:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
        return counts.unpivot([], df.columns, "COLUMN_NAME", "NUM_NULLS").select(
            F.lit(table).alias("TABLE_NAME"), "COLUMN_NAME", "NUM_NULLS"
        )

    return reduce(DataFrame.unionByName, [nulls(t, df) for t, df in tables.items()])


def column_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Distinct values, nulls and whether the column holds one value only.

    The columns are stacked and counted by value, so each column is spread over its values and a
    frequent value is reduced before the shuffle.
    """

    def profile(table: str, df: DataFrame) -> DataFrame:
        text = df.select([F.col(c).cast("string").alias(c) for c in df.columns])
        stacked = text.unpivot([], df.columns, "COLUMN_NAME", "VALUE")
        values = stacked.groupBy("COLUMN_NAME", "VALUE").agg(F.count(F.lit(1)).alias("n"))
        return values.groupBy("COLUMN_NAME").agg(
            F.count("VALUE").alias("NUM_DISTINCT"),
            F.coalesce(F.sum(F.when(F.col("VALUE").isNull(), F.col("n"))), F.lit(0)).alias("NUM_NULLS"),
            (F.count("VALUE") == 1).alias("IS_CONSTANT"),
        ).select(F.lit(table).alias("TABLE_NAME"), "*")

    return reduce(DataFrame.unionByName, [profile(t, df) for t, df in tables.items()])


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("NUM_ROWS")).filter("NUM_ROWS > 1")


def duplicate_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows beyond the first among rows equal in every column, per table. Rows are told apart by 128 bits of hash
    over their values and which of them are null; the values themselves are not shuffled."""

    def digest(df: DataFrame) -> DataFrame:
        # a null leaves a hash as it was
        values = [part for c in df.columns for part in (F.col(c).isNull(), F.col(c))]
        return df.select(F.xxhash64(*values).alias("_one"), F.xxhash64(F.lit("other"), *reversed(values)).alias("_two"))

    copies = [
        digest(df).groupBy("_one", "_two").agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("NUM_DUPLICATES"))
        .select(F.lit(t).alias("TABLE_NAME"), "NUM_DUPLICATES")
        for t, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, copies)


def loyalty_card_consistency(items: DataFrame) -> DataFrame:
    """Lines by loyalty flag and absence of a card number; members should have one, others not."""
    return items.groupBy(
        "IS_LOYALTY", F.col("PRINTED_CARD_NUMBER").isNull().alias("CARD_IS_NULL")
    ).agg(F.count(F.lit(1)).alias("NUM_LINES"))


def options_per_line(lines: DataFrame) -> DataFrame:
    """How many lines have how many options, from enriched lines; none counts as zero."""
    return lines.groupBy(F.coalesce("NUM_OPTIONS", F.lit(0)).alias("NUM_OPTIONS")).agg(
        F.count(F.lit(1)).alias("NUM_LINES")
    )
