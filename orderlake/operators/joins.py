"""Joins of a line-grain frame with a frame that has one row per key."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_HASH = "_key_hash"


def join_unique(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, null_safe: bool = False
) -> DataFrame:
    """``left`` joined (``left``, ``inner``, ``left_semi``, ``left_anti``) with ``right``, which has
    been grouped to one row per key. Null keys match nothing unless ``null_safe``.

    The key hash is joined on as well. It changes no result, but the grouped side is not yet
    partitioned by it, so both inputs of the join are plain shuffles. Only then can AQE split a key
    that holds a large share of ``left`` over many tasks; on the grouping's own partitioning it
    leaves such a key to one task. The price is a shuffle of the grouped rows.
    """
    key_hash = F.xxhash64(*keys)
    left, right = left.withColumn(_HASH, key_hash), right.withColumn(_HASH, key_hash)
    if not null_safe:
        return left.join(right, [_HASH, *keys], how).drop(_HASH)
    renamed = {k: f"_right_{k}" for k in [_HASH, *keys]}
    right = right.withColumnsRenamed(renamed)
    match = reduce(and_, [F.col(k).eqNullSafe(F.col(r)) for k, r in renamed.items()])
    return left.join(right, match, how).drop(_HASH, *renamed.values())


def present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without a null in the columns. Plain conditions reach the scan, ``dropna`` does not."""
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that can match at all: no nulls, each once (reduced before the shuffle)."""
    return present(df.select(*keys), keys).distinct()
