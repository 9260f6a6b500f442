"""The three jobs: load raw batches, rebuild silver days, publish reports."""

from __future__ import annotations

import datetime as dt
from typing import Protocol

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from orderlake.functions.columns import as_date, per_order
from orderlake.operators import customers, enrich, history, incremental, quality, sales
from orderlake.operators.joins import join_unique
from orderlake.operators.ranking import tile_edges
from orderlake.schemas import LINE_KEY, LOADS, REQUIRED_ITEM_COLUMNS
from orderlake.sources.lake import SLICE_KEY, STATES, Batch, Lake, edges_text
from orderlake.sources.sinks import DAY_PARTS, replace_table, write_partitions


class Source(Protocol):
    def highest(self) -> str | None: ...

    def batch(self, table: str, lo: str, hi: str) -> DataFrame: ...


def ingest(source: Source, lake: Lake, load_date: str | dt.date, run_id: str = "manual") -> Batch:
    """Load what is newer than the last committed batch.

    The upper end is fixed before anything is read, so that all tables see the same range and a line
    that arrives meanwhile waits, with its options, for the next load. Without newer rows the batch
    holds the calendar alone and the watermark stays.
    """
    lo = lake.watermark()
    hi = max(source.highest() or lo, lo)
    batch = _write(source, lake, Batch(lake.next_batch_id(), as_date(load_date), lo, hi, {}))
    lake.commit_batch(batch, run_id)
    return batch


def replay(source: Source, lake: Lake, batch_id: int, run_id: str = "replay") -> Batch:
    """Read a committed batch again with its own bounds, as its next generation. Readers see the old one
    until the new one is committed; silver takes it in with its next run."""
    (batch,) = lake.batches({batch_id})
    again = _write(source, lake, lake.next_generation(batch))
    lake.commit_batch(again, run_id)
    return again


def _write(source: Source, lake: Lake, batch: Batch) -> Batch:
    for table in LOADS:
        batch.rows[table] = lake.write_batch(source.batch(table, batch.lo, batch.hi), table, batch)
    return batch


def silver(
    lake: Lake, batch_ids: set[int] | None = None, required: list[str] = REQUIRED_ITEM_COLUMNS
) -> list[dt.date | None]:
    """Take new batches into silver, or redo the given ones; returns the days rebuilt.

    Touched are the lines of these batches and the lines of their options. Of each the newest version and
    the newest group of options count; a load that read both tables also says that a line has no options.
    The days such lines are or were on, the day of lines without a time among them, are written anew: the
    published rows of other lines, and the touched ones.

    Where a touched line is in silver, the line index says, of which only the buckets of touched lines are read
    and written. Of silver the days these lines are on are read, and the days rebuilt; of raw data no earlier
    batch. Redone and replayed batches may
    bring an earlier version back, so their lines are made from all batches. Options without a line stay
    open: every run judges them again.
    """
    if "LINEITEM_ID" not in required:
        raise ValueError("LINEITEM_ID identifies a line and has to be required")
    new = lake.batches(batch_ids) if batch_ids else lake.new_batches()
    if not new:
        return []
    calendar_batch = lake.newest_with("date_dim")
    date_dim = lake.read_batches("date_dim", [calendar_batch] if calendar_batch else []).drop("load_date", "batch_id")
    calendar = enrich.parse_calendar(date_dim)
    quality.require_parsed_dates(calendar)

    base = lake.silver_run()
    run, first = lake.claim("silver", base + 1), base == 0
    newest_taken = lake.ledger("silver").filter(~F.col("is_day")).agg(F.max("batch_id")).first()[0] or 0
    in_order = all(b.generation == 1 for b in new) and newest_taken < new[0].batch_id

    lines = quality.valid_items(lake.read_batches("order_items", new), required)
    corrupt = quality.corrupt_items(lake.read_batches("order_items", new), required)
    options = lake.read_batches("order_item_options", new)
    deciding = [b.batch_id for b in (new if in_order else lake.batches()) if b.decides_options]
    pending = options
    if in_order:
        if not first:
            pending = options.unionByName(lake.rejects("order_item_options").drop(quality.REASON))
        touched = _keys(lines, pending)
    else:
        ids = [b.batch_id for b in new]
        touched = _keys(lake.read_generations("order_items", ids), lake.read_generations("order_item_options", ids))

    def keep(frame: DataFrame, name: str) -> DataFrame:
        """Write what several readers need, so that it is worked out once."""
        return lake.spark.read.schema(frame.schema).parquet(replace_table(frame, lake.zone("staging", f"run={run}", name)))

    touched = keep(touched.withColumn("bucket", lake.in_bucket("LINEITEM_ID")), "touched")
    buckets = sorted(row.bucket for row in touched.select("bucket").distinct().collect())
    touched = touched.drop("bucket")
    # where the touched lines are now, and from there these lines themselves
    indexed = not first and lake.has_line_index(base)
    index = None if first else _index(lake, base, buckets if indexed else None)
    met = keep(_of(index, touched).select(*LINE_KEY, "ORDER_DATE"), "met") if index else None
    old_days = _days(met) if met else []
    old = keep(_of(lake.silver("order_items_enriched", base).filter(_on_days(old_days)), touched), "old") if met else None

    if in_order:
        fresh, orphans = _merged(old, met, lines, pending, deciding)
    else:
        every = quality.valid_items(lake.read_batches("order_items"), required)
        fresh, _ = _merged(None, None, _of(every, touched), _of(lake.read_batches("order_item_options"), touched), deciding)
        orphans = quality.orphan_options(lake.read_batches("order_item_options"), every)

    replace_table(corrupt.drop("load_date"), lake.zone("rejects", "order_items", f"run={run}"))
    replace_table(orphans, lake.zone("rejects", "order_item_options", f"run={run}"))
    replace_table(calendar, lake.zone("prod", "date_dim", f"run={run}"))
    fresh = keep(fresh, "fresh")
    rebuilt = sorted({*old_days, *_days(fresh)}, key=lambda d: (d is None, d))
    where = fresh.select("LINEITEM_ID", "ORDER_ID", "ORDER_DATE").distinct()
    written = fresh
    if met:
        others = lake.silver("order_items_enriched", base).filter(_on_days(rebuilt))
        written = others.join(touched, "LINEITEM_ID", "left_anti").unionByName(fresh)
        where = index.drop("bucket").join(touched, "LINEITEM_ID", "left_anti").unionByName(where)
    write_partitions(written, lake.zone("prod", "order_items_enriched", f"run={run}"), DAY_PARTS)
    lake.write_line_index(where, run)
    if not indexed:
        buckets = list(range(lake.buckets))
    lake.commit(
        "silver",
        [{"run": run, "batch_id": b.batch_id, "generation": b.generation, "is_day": False} for b in new]
        + [{"run": run, "is_day": True, "day": d} for d in rebuilt]
        + [{"run": run, "bucket": b, "buckets": lake.buckets} for b in buckets],
        f"after-{base:08d}",
    )
    return rebuilt


def _index(lake: Lake, run: int, buckets: list[int] | None) -> DataFrame:
    """The kept line index, of the buckets given; if none is kept, all of it from the published lines."""
    if buckets is not None:
        return lake.line_index(buckets)
    lines = lake.silver("order_items_enriched", run).select("LINEITEM_ID", "ORDER_ID", "ORDER_DATE").distinct()
    return lines.withColumn("bucket", lake.in_bucket("LINEITEM_ID"))


def _days(rows: DataFrame) -> list[dt.date | None]:
    return [row.ORDER_DATE for row in rows.select("ORDER_DATE").distinct().collect()]


def _keys(lines: DataFrame, options: DataFrame) -> DataFrame:
    """The lines touched by rows of either table."""
    both = lines.select("LINEITEM_ID").union(options.select("LINEITEM_ID"))
    return both.filter(F.col("LINEITEM_ID").isNotNull()).distinct()


def _of(rows: DataFrame, touched: DataFrame) -> DataFrame:
    return rows.join(touched, "LINEITEM_ID", "left_semi")


def _merged(
    published: DataFrame | None, met: DataFrame | None, lines: DataFrame, options: DataFrame, deciding: list[int]
) -> tuple[DataFrame, DataFrame]:
    """Touched lines with their totals, and the options no line takes. ``published`` are the touched lines as
    silver has them, ``met`` their keys.

    A line's options are the newest group given for it, unless the line came later with a load that read
    options as well. Without either it keeps what silver has.
    """
    current = incremental.newest_per_key(lines, ["LINEITEM_ID"], "batch_id").drop("load_date")
    groups = incremental.newest_per_key(options, LINE_KEY, "batch_id")
    totals = enrich.roll_up_options(groups, [*LINE_KEY, "batch_id"]).withColumnRenamed("batch_id", "_given")
    said = F.max(F.when(F.col("batch_id").isin(deciding), F.col("batch_id"))).alias("_decided")
    decided = lines.groupBy("LINEITEM_ID").agg(said)
    kept = {"TOTAL_OPTIONS_PRICE": "_kept_price", "NUM_OPTIONS": "_kept_number"}
    known = lines.select(*LINE_KEY)
    if published is not None:
        before = published.select("LINEITEM_ID", *[F.col(c).alias(k) for c, k in kept.items()]).dropDuplicates(["LINEITEM_ID"])
        current = join_unique(current, before, ["LINEITEM_ID"], "left")
        # lines that only get options are taken from silver
        old = published.join(lines.select("LINEITEM_ID").distinct(), "LINEITEM_ID", "left_anti")
        old = old.withColumnsRenamed(kept).drop("LINE_REVENUE", "ORDER_DATE", *DAY_PARTS).withColumn("batch_id", F.lit(None).cast("bigint"))
        current = current.unionByName(old)
        known = known.union(met.select(*LINE_KEY))
    else:
        current = current.withColumn("_kept_price", F.lit(None).cast("decimal(31,2)")).withColumn("_kept_number", F.lit(None).cast("bigint"))
    joined = join_unique(join_unique(current, totals, LINE_KEY, "left"), decided, ["LINEITEM_ID"], "left")
    given = F.col("_given").isNotNull() & (F.col("_decided").isNull() | (F.col("_given") >= F.col("_decided")))
    keep = F.col("_decided").isNull() & F.col("_given").isNull()
    chosen = {c: F.when(given, F.col(c)).when(keep, F.col(k)) for c, k in kept.items()}
    own = joined.withColumns(chosen).drop("_given", "_decided", "batch_id", *kept.values())
    orphans = quality.orphan_options(options, known)
    return enrich.add_order_date(enrich.with_revenue(own)), orphans


def _on_days(days: list[dt.date | None]):
    """Rows of the given days, the day of rows without a time among them; only their folders are read."""
    inside = F.make_date("year", "month", "day").isin([d for d in days if d is not None])
    return inside | F.col("year").isNull() if None in days else inside


def gold(lake: Lake, reference_date: str | dt.date, churn_days: int = customers.CHURN_DAYS) -> int:
    """Publish the reports as one new version, visible once all of them are written.

    What reports are made of is kept between versions. Read are the days rebuilt since the last version, as they
    are and as they were; orders that differ say which customers and orders are touched, and only the buckets
    of these are read and written anew. Sales of other days are taken from the last version. Tiers depend on
    all customers: where they begin is found anew from one kept row per customer, and applied when a report
    is read. The tiers of this run close and open intervals of the tier history, unless a later day is in it.
    """
    day = as_date(reference_date)
    run, last, base = lake.silver_run(), lake.published(), lake.report_version()
    version = lake.claim("reports", base + 1)
    kept = last is not None and last.buckets == lake.buckets
    days = lake.days_since(last.silver_run) if kept else None

    def slices(at: int) -> DataFrame:
        lines = lake.silver("order_items_enriched", at)
        return sales.order_slices(lines if days is None else lines.filter(_on_days(days)), "USER_ID", "RESTAURANT_ID", "ORDER_DATE")

    def keep(frame: DataFrame, name: str) -> DataFrame:
        path = replace_table(frame, lake.zone("staging", f"version={version}", name))
        return lake.spark.read.schema(frame.schema).parquet(path)

    now = keep(slices(run), "slices")
    changed = keep(_changed(now, slices(last.silver_run) if kept else None), "changed")
    touched = {
        "USER_ID": _customer_state(lake, version, changed.filter(F.col("USER_ID").isNotNull()), kept),
        "ORDER_ID": _location_state(lake, version, changed, kept),
    }

    sold = sales.daily_sales(now)
    if kept:
        others = lake.report("daily_sales").filter(~_of_days(days))
        sold = sold.unionByName(others.select([F.col(c).cast(kind).alias(c) for c, kind in sold.dtypes]))
    replace_table(sold, lake.zone("reporting", f"version={version}", "daily_sales"))
    parts = lake.state_with("location_parts", version, touched["ORDER_ID"], kept).groupBy("RESTAURANT_ID")
    places = parts.agg(F.sum("TOTAL_REVENUE").alias("TOTAL_REVENUE"), F.sum("NUM_ORDERS").alias("NUM_ORDERS"))
    replace_table(places.withColumn("AOV", per_order("TOTAL_REVENUE", "NUM_ORDERS")), lake.zone("reporting", f"version={version}", "location_perf"))

    people = lake.state_with("customers", version, touched["USER_ID"], kept).select("USER_ID", "LATEST_LTV")
    (edges,) = tile_edges(people, customers.TILES, [customers.SPENDING])
    lake.commit(
        "reports",
        [
            {
                "version": version, "reference_date": day, "churn_days": churn_days, "silver_run": run, "buckets": lake.buckets,
                "edges": edges_text(edges), "tags_version": _tag_history(lake, version, customers.tagged(people, edges), day, last),
            },
            *({"version": version, "state": key, "bucket": b, "buckets": lake.buckets} for key, own in touched.items() for b in own),
        ],
        f"after-{base:08d}",
    )
    return version


def _of_days(days: list[dt.date | None]):
    inside = F.coalesce(F.col("ORDER_DATE").isin([d for d in days if d is not None]), F.lit(False))
    return inside | F.col("ORDER_DATE").isNull() if None in days else inside


def _amount() -> Column:
    return F.struct(F.col("LINE_REVENUE").cast("decimal(38,2)").alias("LINE_REVENUE"), "NUM_LINES")


def _changed(now: DataFrame, before: DataFrame | None) -> DataFrame:
    """The slices that are not as they were; ``now`` is null for those that are gone."""
    new = now.select(*SLICE_KEY, _amount().alias("now"))
    if before is None:
        return new
    nothing = F.lit(None).cast(new.schema["now"].dataType)
    both = new.withColumn("before", nothing).unionByName(before.select(*SLICE_KEY, nothing.alias("now"), _amount().alias("before")))
    # keys may be null, so they are grouped, not joined
    both = both.groupBy(*SLICE_KEY).agg(F.max("now").alias("now"), F.max("before").alias("before"))
    return both.filter(~F.col("now").eqNullSafe(F.col("before"))).drop("before")


def _applied(lake: Lake, table: str, changed: DataFrame, kept: bool) -> tuple[DataFrame, list[int]]:
    """The buckets of a table of slices that the changes touch, with the changes, and their numbers."""
    key = STATES[table][0]
    changed = changed.withColumn("bucket", lake.in_bucket(key))
    buckets = sorted(row.bucket for row in changed.select("bucket").distinct().collect())
    rows = changed.select(*SLICE_KEY, "bucket", F.col("now").alias("amount"), F.lit(True).alias("newer"))
    if kept:
        known = lake.state(table, buckets=buckets).select(*SLICE_KEY, "bucket", _amount().alias("amount"), F.lit(False).alias("newer"))
        rows = rows.unionByName(known).groupBy(*SLICE_KEY, "bucket").agg(F.max_by("amount", "newer").alias("amount"))
    return rows.filter(F.col("amount").isNotNull()).select(*SLICE_KEY, "bucket", "amount.*"), buckets


def _customer_state(lake: Lake, version: int, changed: DataFrame, kept: bool) -> list[int]:
    """Write the touched buckets of what is kept per customer; returns them."""
    orders, buckets = _applied(lake, "customer_orders", changed, kept)
    lake.write_state(orders, "customer_orders", version)
    orders, bucket = lake.state_with("customer_orders", version, buckets, False), lake.in_bucket("USER_ID")
    daily = customers.daily_spend(orders)
    lake.write_state(customers.with_latest(daily).withColumn("bucket", bucket), "customer_days", version)
    orders_of = orders.groupBy("USER_ID").agg(
        F.count_distinct("ORDER_ID").alias("FREQUENCY"), F.sum("LINE_REVENUE").alias("MONETARY"), F.max("ORDER_DATE").alias("LAST_ORDER")
    )
    days = lake.state_with("customer_days", version, buckets, False)
    value = days.groupBy("USER_ID").agg(F.max("LATEST_LTV").alias("LATEST_LTV"))
    lake.write_state(orders_of.join(value, "USER_ID").withColumn("bucket", bucket), "customers", version)
    return buckets


def _location_state(lake: Lake, version: int, changed: DataFrame, kept: bool) -> list[int]:
    """Write the touched buckets of what is kept per order. An order is in one bucket, so numbers of distinct
    orders per bucket and restaurant add up."""
    orders, buckets = _applied(lake, "location_orders", changed, kept)
    lake.write_state(orders, "location_orders", version)
    orders = lake.state_with("location_orders", version, buckets, False)
    parts = orders.groupBy("bucket", "RESTAURANT_ID").agg(F.sum("LINE_REVENUE").alias("TOTAL_REVENUE"), F.count_distinct("ORDER_ID").alias("NUM_ORDERS"))
    lake.write_state(parts, "location_parts", version)
    return buckets


def _tag_history(lake: Lake, version: int, tags: DataFrame, day: dt.date, last: Row | None) -> int:
    """Advance the tier history to a day; returns the version that holds it."""
    newest = last.tags_version if last else 0
    if newest and lake.published(newest).reference_date > day:
        return newest
    closed, open_ = history.advance(lake.open_tags(newest), tags, day)
    replace_table(closed, lake.zone("state", "closed_tags", f"version={version}"))
    replace_table(open_, lake.zone("state", "open_tags", f"version={version}"))
    return version
