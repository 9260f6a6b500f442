"""Incremental reads from a database, as predicates the database evaluates itself.

Each read is cut into slices of the load's time range, one task and one connection per slice. Slices are cut
where the rows are: the database counts rows per stretch of time, stretches with too many are cut further,
and neighbours with few are put together. An instant with too many rows is split by a hash of the line's
key. A child row has no time of its own and takes that of its newest parent in range, so it falls into
exactly one slice.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from orderlake.functions.columns import as_timestamp, watermark_text
from orderlake.operators.incremental import load_spec
from orderlake.schemas import BY_PARENT, BY_WATERMARK, FLOOR_WATERMARK, FULL_RELOAD, LINE_KEY

#: The shortest stretch of time; pieces a stretch with too many rows is cut into; stretches counted by one query.
INSTANT = dt.timedelta(microseconds=1)
CUTS, CASES = 16, 256
#: Fixed value: how the source's database deals a key into parts.
KEY_HASH = "ABS(CHECKSUM({key}) % {parts})"


def time_literal(value: dt.datetime) -> str:
    return "'" + value.replace(tzinfo=None).isoformat(timespec="microseconds") + "'"


@dataclass(frozen=True)
class Slice:
    """Rows later than ``lo`` and not later than ``hi``; if ``parts`` is more than one, part ``part`` of these by
    the hash of their key."""

    lo: dt.datetime
    hi: dt.datetime
    part: int = 0
    parts: int = 1


def time_slices(lo: dt.datetime, hi: dt.datetime, n: int) -> list[Slice]:
    """``(lo, hi]`` cut into at most ``n`` adjoining pieces of one length."""
    step = (hi - lo) / n
    edges = sorted({lo, *(lo + step * i for i in range(1, n)), hi})
    return [Slice(a, b) for a, b in zip(edges, edges[1:])]


def depth_slices(count: Callable[[list[Slice]], list[int]], lo: dt.datetime, hi: dt.datetime, n: int, by_hash: bool = True) -> list[Slice]:
    """``(lo, hi]`` cut into slices of at most a share of 1 / ``n`` of the rows each, and at most about twice as
    many slices. ``count`` gives the rows of each of some slices; it is asked once per round, for the
    stretches with too many rows, until these are one microsecond long. Such an instant is split by hash.
    """
    counted = [*zip(whole := time_slices(lo, hi, 4 * n), count(whole))]
    share = max(1, sum(rows for _, rows in counted) // n)
    while heavy := [s for s, rows in counted if rows > share and s.hi - s.lo > INSTANT]:
        finer = [part for s in heavy for part in time_slices(s.lo, s.hi, CUTS)]
        counted = sorted([(s, rows) for s, rows in counted if s not in heavy] + [*zip(finer, count(finer))], key=lambda c: c[0].lo)
    slices: list[Slice] = []
    held = 0
    for s, rows in counted:
        if slices and slices[-1].parts == 1 and held + rows <= share:
            slices[-1], held = Slice(slices[-1].lo, s.hi), held + rows
        elif rows > share and by_hash:
            parts = -(-rows // share)
            slices += [Slice(s.lo, s.hi, part, parts) for part in range(parts)]
            held = rows
        else:
            slices.append(s)
            held = rows
    return slices


def slice_predicates(table: str, slices: list[Slice], child: str = "SRC", key_hash: str = KEY_HASH) -> list[str] | None:
    """One condition per slice for the rows of ``table``, or ``None`` for a full reload. ``child`` is the name under
    which the table's own columns are visible in the condition."""
    spec = load_spec(table)
    if spec.strategy == FULL_RELOAD:
        return None
    if spec.strategy == BY_WATERMARK:
        time = spec.watermark
    elif spec.strategy == BY_PARENT:
        last = time_literal(slices[-1].hi)
        match = " AND ".join(f"p.{k} = {child}.{k}" for k in spec.keys)
        time = (
            f"(SELECT MAX(p.{spec.watermark}) FROM {spec.parent} p "
            f"WHERE {match} AND p.{spec.watermark} <= {last})"
        )
    else:
        raise ValueError(f"unknown load strategy {spec.strategy!r} for table {table!r}")
    key = f"COALESCE({child}.{LINE_KEY[-1]}, '')"
    return [
        f"{time} > {time_literal(s.lo)} AND {time} <= {time_literal(s.hi)}"
        + (f" AND {key_hash.format(key=key, parts=s.parts)} = {s.part}" if s.parts > 1 else "")
        for s in slices
    ]


@dataclass(frozen=True)
class JdbcSource:
    """A database holding the source tables. ``options`` are Spark's JDBC options (user, driver,
    encryption and so on), supplied by the caller. ``key_hash`` is the database's way to deal a key into parts,
    from 0 on; None where there is none, and then an instant is one slice, however many rows it has."""

    spark: SparkSession
    url: str
    options: dict[str, str] = field(default_factory=dict)
    slices: int = 16
    key_hash: str | None = KEY_HASH

    def _query(self, query: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(url=self.url, query=query, **self.options).load()

    def _extreme(self, function: str, table: str) -> str | None:
        column = load_spec(table).watermark
        return self._query(f"SELECT {function}({column}) AS t FROM {table}").select(watermark_text("t")).first()[0]

    def _count(self, table: str, slices: list[Slice]) -> list[int]:
        """The rows of each slice, counted by the database in one pass."""
        found: list[int] = []
        for first in range(0, len(slices), CASES):
            conditions = slice_predicates(table, slices[first : first + CASES], table)
            sums = ", ".join(f"SUM(CASE WHEN {c} THEN 1 ELSE 0 END) AS n{i}" for i, c in enumerate(conditions))
            found += [int(n or 0) for n in self._query(f"SELECT {sums} FROM {table}").first()]
        return found

    def highest(self, table: str = "order_items") -> str | None:
        """Largest watermark in the table, computed by the database."""
        return self._extreme("MAX", table)

    def batch(self, table: str, lo: str, hi: str) -> DataFrame:
        """The rows of ``table`` in the load ``(lo, hi]``."""
        spec, low, high = load_spec(table), as_timestamp(lo), as_timestamp(hi)
        properties = dict(self.options)
        if spec.strategy == FULL_RELOAD:
            return self.spark.read.jdbc(self.url, table, properties=properties)
        timed = spec.parent or table
        begin = low
        if low == as_timestamp(FLOOR_WATERMARK) and low < high:
            # first load: cut the range that holds data, not the centuries before it
            first = self._extreme("MIN", timed)
            begin = max(low, as_timestamp(first) - INSTANT) if first is not None else low
        slices = [Slice(low, high)]
        if begin < high:
            slices = depth_slices(lambda some: self._count(timed, some), begin, high, self.slices, self.key_hash is not None)
        predicates = slice_predicates(table, slices, key_hash=self.key_hash or KEY_HASH)
        return self.spark.read.jdbc(self.url, f"{table} SRC", predicates=predicates, properties=properties)
