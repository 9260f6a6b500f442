"""Exact global tiles and ranks without sorting the rows or gathering them in one partition.

A tile begins at one row, and that row is found by counting. Each round counts the rows per bucket of what
is still in question, buckets being literal ranges of the value, and only looks further into the buckets in
which a tile begins. Rows of one value are told apart by the prefix of their key, so a tie of any size is
cut exactly. What comes to the driver is a bounded number of counts and a few rows per edge; the rows
themselves are only compared with the edges, in place.

A frame that is tiled has to give the same rows whenever it is evaluated.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from operator import add, or_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from orderlake.operators.once import computed_once

#: Buckets a range of values is cut into per round; rows of a range that are simply looked at.
BUCKETS, FEW = 4096, 2048
#: Characters of the key told apart per round.
KEY_STEP = 2
#: Rows that share a window when ranks are counted, and the least number of such windows.
WINDOW_ROWS, LEAST_WINDOWS = 1 << 20, 8

_WHOLE = "decimal(38,0)"


@dataclass(frozen=True)
class Order:
    """Rows by ``value`` and, where it is equal, by ``key``, a string that is never null and unique among
    the rows. Null is the smallest value: first, or last if ``descending``. Only rows ``among`` take part."""

    value: str
    key: str
    descending: bool = False
    among: str | None = None

    def scale(self, df: DataFrame) -> int:
        kind = df.schema[self.value].dataType
        if isinstance(kind, DecimalType):
            return kind.scale
        if isinstance(kind, IntegralType):
            return 0
        raise TypeError(f"{self.value} is {kind.simpleString()}; tiles need whole or decimal numbers")


@dataclass(frozen=True)
class Edge:
    """The first row of a tile. Without a key it is the first of all rows of its value, before which there are
    ``first`` rows."""

    value: Decimal | None
    key: str | None
    first: int

    def reached(self, order: Order) -> Column:
        """Whether a row is this one or comes after it."""
        value = F.col(order.value)
        if self.value is None:
            later, same = (F.lit(False) if order.descending else value.isNotNull()), value.isNull()
        else:
            edge = F.lit(self.value)
            later, same = (value < edge if order.descending else value > edge), value == edge
            later = later | value.isNull() if order.descending else later
        if self.key is not None:
            same = same & (F.col(order.key) >= self.key)
        return F.coalesce(later, F.lit(False)) | F.coalesce(same, F.lit(False))


@dataclass
class _Range:
    """Rows of one order still in question: levels from ``low`` to ``high``, keys with a prefix; ``before`` rows
    come earlier, ``rows`` are inside, and the rows at ``wanted`` positions are looked for. A range of one
    level, the rows of which begin after ``first`` others, may hold only some of them."""

    order: int
    low: int
    high: int
    prefix: str
    before: int
    rows: int
    wanted: list[int]
    first: int | None = None

    def holds(self) -> Column:
        level = F.col(f"_level{self.order}")
        inside = level.between(F.lit(Decimal(self.low)), F.lit(Decimal(self.high)))
        return inside & F.col(f"_key{self.order}").startswith(self.prefix) if self.prefix else inside

    @property
    def step(self) -> int:
        return -(-(self.high - self.low + 1) // BUCKETS)

    def bucket(self) -> Column:
        """What the rows inside are counted by, in the order of the rows."""
        if self.low < self.high:
            level = F.col(f"_level{self.order}") - F.lit(Decimal(self.low))
            # numbers of one width sort like text
            return F.lpad(F.floor(level / F.lit(Decimal(self.step))).cast("string"), 8, "0")
        return F.substring(F.col(f"_key{self.order}"), 1, len(self.prefix) + KEY_STEP)


def starts_of(n: int, k: int) -> list[int]:
    """Positions (from 0) of the first rows of tiles 2 to ``k``; the first ``n % k`` tiles hold one row more."""
    size, larger = divmod(n, k)
    return [p for p in (t * size + min(t, larger) for t in range(1, k)) if p < n]


def tile_edges(df: DataFrame, k: int, orders: list[Order]) -> list[list[Edge]]:
    """Per order the first rows of tiles 2 to ``k``, fewer if there are fewer rows."""
    return [edges for edges, _ in _edges(df, lambda n: k, orders)]


def _edges(df: DataFrame, tiles, orders: list[Order]) -> list[tuple[list[Edge], int]]:
    scales = [order.scale(df) for order in orders]
    levels = {}
    for i, (order, scale) in enumerate(zip(orders, scales)):
        level = (F.col(order.value) * F.lit(Decimal(10**scale))).cast(_WHOLE)
        inside = F.col(order.among) if order.among else F.lit(True)
        levels |= {
            f"_level{i}": -level if order.descending else level,
            f"_key{i}": F.when(inside, F.col(order.key)),
        }
    # the few columns the rounds look at; kept for them only
    slim = df.select([c.alias(name) for name, c in levels.items()]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return [*_search(slim, tiles, orders, scales)]
    finally:
        slim.unpersist()


def _search(slim: DataFrame, tiles, orders: list[Order], scales: list[int]):
    taken = [F.col(f"_key{i}").isNotNull() for i in range(len(orders))]
    columns = []
    for i, inside in enumerate(taken):
        level = F.when(inside, F.col(f"_level{i}"))
        columns += [F.count_if(inside).alias(f"n{i}"), F.min(level).alias(f"low{i}"), F.max(level).alias(f"high{i}")]
    seen = slim.agg(*columns).first()
    ranges, found, nulls, filled = [], [{} for _ in orders], [], {}
    for i, order in enumerate(orders):
        n, low, high = seen[f"n{i}"], int(seen[f"low{i}"] or 0), int(seen[f"high{i}"] or 0)
        # nulls get a level of their own, before or after all others
        nulls.append(high + 1 if order.descending else low - 1)
        filled[f"_level{i}"] = F.when(taken[i], F.coalesce(F.col(f"_level{i}"), F.lit(Decimal(nulls[i]))))
        if wanted := starts_of(n, tiles(n)):
            ranges.append(_Range(i, min(low, nulls[i]), max(high, nulls[i]), "", 0, n, wanted))
    rows = slim.withColumns(filled)
    while ranges:
        few = [r for r in ranges if r.rows <= FEW]
        for r, (level, key) in _look(rows, few):
            for p in r.wanted:
                at = level[p - r.before]
                first = r.before + level.index(at) if r.first is None else r.first
                found[r.order][p] = (at, key[p - r.before], first)
        ranges = [part for r, parts in _count(rows, [r for r in ranges if r.rows > FEW]) for part in _settle(r, parts, found)]
    for i, (order, scale) in enumerate(zip(orders, scales)):
        sign = -1 if order.descending else 1
        edges = [
            Edge(None if level == nulls[i] else Decimal(sign * level).scaleb(-scale), key, first)
            for _, (level, key, first) in sorted(found[i].items())
        ]
        yield edges, seen[f"n{i}"]


def _tagged(rows: DataFrame, ranges: list[_Range], value) -> DataFrame:
    """Each row once for every range it lies in, with the number of the range and ``value(range)``."""
    parts = [F.when(r.holds(), F.struct(F.lit(i).alias("range"), *value(r))) for i, r in enumerate(ranges)]
    inside = reduce(or_, [r.holds() for r in ranges])
    return rows.filter(inside).select(F.inline(F.filter(F.array(*parts), lambda part: part.isNotNull())))


def _look(rows: DataFrame, ranges: list[_Range]):
    """The levels and keys of all rows of small ranges, in order."""
    if not ranges:
        return
    tagged = _tagged(rows, ranges, lambda r: (F.col(f"_level{r.order}").alias("level"), F.col(f"_key{r.order}").alias("key")))
    listed = [[] for _ in ranges]
    for row in tagged.collect():
        listed[row.range].append((int(row.level), row.key))
    for r, own in zip(ranges, listed):
        yield r, tuple(zip(*sorted(own)))


def _count(rows: DataFrame, ranges: list[_Range]):
    """Per range its buckets in order: (rows, least and highest level, least and highest key)."""
    if not ranges:
        return
    tagged = _tagged(
        rows, ranges, lambda r: (r.bucket().alias("bucket"), F.col(f"_level{r.order}").alias("level"), F.col(f"_key{r.order}").alias("key"))
    )
    counts = tagged.groupBy("range", "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("level"), F.max("level"), F.min("key"), F.max("key")
    )
    listed = [[] for _ in ranges]
    for number, bucket, n, low, high, least, most in counts.collect():
        listed[number].append((bucket, n, int(low), int(high), least, most))
    for r, own in zip(ranges, listed):
        yield r, sorted(own)


def _settle(r: _Range, buckets: list[tuple], found: list[dict]) -> list[_Range]:
    """The buckets in which a wanted row lies, unless it is known already."""
    parts, before = [], r.before
    for _, n, low, high, least, most in buckets:
        inside = [p for p in r.wanted if before <= p < before + n]
        first = None
        if low == high:
            first = before if r.first is None else r.first
            if before == first and before in inside:
                found[r.order][before] = (low, None, first)
                inside.remove(before)
        if inside and n == 1:
            found[r.order][inside.pop()] = (low, least, before if first is None else first)
        if inside:
            prefix = os.path.commonprefix([least, most]) if low == high else ""
            parts.append(_Range(r.order, low, high, prefix, before, n, inside, first))
        before += n
    return parts


def tile_number(edges: list[Edge], order: Order) -> Column:
    """The tile of a row from the edges alone, for any frame that has the columns of the order."""
    return reduce(add, [edge.reached(order).cast("int") for edge in edges], F.lit(1))


def tile(df: DataFrame, k: int, order: Order, name: str) -> DataFrame:
    """``ntile(k)`` over the whole frame."""
    df = computed_once(df, "tiled")
    (edges,) = tile_edges(df, k, [order])
    return df.withColumn(name, tile_number(edges, order))


def rank_desc(df: DataFrame, value: str, key: str, name: str) -> DataFrame:
    """``rank()`` by ``value``, largest first, nulls last; equal values share the smallest position.

    Rows are ranked in windows of bounded size, each beginning at a known position. Rows of the value a
    window begins with may begin in an earlier one, and take their rank from there.
    """
    df = computed_once(df, "ranked")
    order = Order(value, key, descending=True)
    ((edges, n),) = _edges(df, _windows, [order])
    begins = [0, *starts_of(n, _windows(n))]
    begin = F.element_at(F.array(*map(F.lit, begins)), F.col("_window"))
    inside = F.rank().over(Window.partitionBy("_window").orderBy(F.desc_nulls_last(value)))
    rank = begin + inside
    for number, edge in enumerate(edges, 2):
        tied = (F.col("_window") == number) & F.col(value).eqNullSafe(F.lit(edge.value))
        rank = F.when(tied, F.lit(edge.first + 1)).otherwise(rank)
    return df.withColumn("_window", tile_number(edges, order)).withColumn(name, rank.cast("int")).drop("_window")


def _windows(n: int) -> int:
    return max(LEAST_WINDOWS, -(-n // WINDOW_ROWS))
