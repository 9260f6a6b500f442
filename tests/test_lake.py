"""The load protocol: nothing is lost or counted twice over re-runs, crashes, split days and resends."""

import datetime as dt
from contextlib import contextmanager
from decimal import Decimal as D
from pathlib import Path

import pytest
from frames import by, calendar, day, items, options
from pyspark.sql import functions as F

from orderlake.functions.columns import watermark_text
from orderlake.operators import customers, sales
from orderlake.plans import jobs
from orderlake.plans.queries import REFERENCE_DATE, Tables, registered
from orderlake.schemas import FLOOR_WATERMARK
from orderlake.sources import lake as lake_module
from orderlake.sources.frames import FrameSource
from orderlake.sources.lake import Batch, Lake, WriterConflict


class Shop:
    """A source that grows."""

    def __init__(self, spark, keys=("01-01-2024", "1/2/24", "03-01-2024")):
        self.spark, self.items, self.options, self.keys = spark, [], [], list(keys)

    def sell(self, line, order, time, price=10, quantity=1, user="u", extras=()):
        self.items.append((line, order, user, time, price, quantity))
        self.options += [(order, line, name, value, 1) for name, value in extras]

    def source(self):
        tables = {
            "order_items": items(self.spark, self.items),
            "order_item_options": options(self.spark, self.options),
            "date_dim": calendar(self.spark, self.keys),
        }
        return FrameSource(tables.get)


@pytest.fixture
def shop(spark):
    return Shop(spark)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), buckets=4)


def revenue(lake):
    return {r.LINEITEM_ID: r.LINE_REVENUE for r in lake.silver("order_items_enriched").collect()}


def raw(lake, table="order_items"):
    return lake.read_batches(table, lake.batches())


def test_first_load_counts_and_moves_the_watermark(lake, shop):
    assert lake.watermark() == FLOOR_WATERMARK
    shop.sell("L1", "A", "2024-01-01T10:00:00.123456", extras=[("x", 2), ("y", 1)])
    shop.sell("L2", "A", None)
    batch = jobs.ingest(shop.source(), lake, "2024-01-01", run_id="r1")
    # a line without a time is never loaded
    assert batch.rows == {"order_items": 1, "order_item_options": 2, "date_dim": 3}
    assert lake.watermark() == "2024-01-01T10:00:00.123456"
    # the newest row itself is not read again
    again = jobs.ingest(shop.source(), lake, "2024-01-02")
    assert again.rows["order_items"] == 0 and lake.watermark() == batch.hi
    assert batch.advanced and not again.advanced


def test_second_run_on_the_same_date_keeps_the_first(lake, shop):
    shop.sell("L1", "A", "2024-01-01T10:00:00")
    jobs.ingest(shop.source(), lake, "2024-01-01")
    shop.sell("L2", "B", "2024-01-01T11:00:00")
    jobs.ingest(shop.source(), lake, "2024-01-01")
    assert {r.LINEITEM_ID for r in raw(lake).collect()} == {"L1", "L2"}
    assert str(raw(lake).first().load_date) == "2024-01-01"


def test_day_spread_over_two_loads(lake, shop):
    shop.sell("L1", "A", "2024-01-01T10:00:00", extras=[("x", 2)])
    shop.sell("L2", "B", "2024-01-02T01:00:00")
    jobs.ingest(shop.source(), lake, "2024-01-02")
    assert jobs.silver(lake) == [day("2024-01-01"), day("2024-01-02")]
    shop.sell("L3", "C", "2024-01-02T09:00:00", price=7)
    jobs.ingest(shop.source(), lake, "2024-01-03")
    assert jobs.silver(lake) == [day("2024-01-02")]
    assert revenue(lake) == {"L1": D("12.00"), "L2": D("10.00"), "L3": D("7.00")}
    assert jobs.silver(lake) == []
    # redoing a batch changes nothing
    jobs.silver(lake, {1})
    assert revenue(lake) == {"L1": D("12.00"), "L2": D("10.00"), "L3": D("7.00")}


def test_line_sent_again_for_another_day_moves(lake, shop):
    shop.sell("L1", "A", "2024-01-01T10:00:00", extras=[("x", 2)])
    shop.sell("L2", "B", "2024-01-02T10:00:00")
    jobs.ingest(shop.source(), lake, "2024-01-02")
    jobs.silver(lake)
    shop.sell("L1", "A", "2024-01-03T10:00:00", price=20)
    jobs.ingest(shop.source(), lake, "2024-01-03")
    assert jobs.silver(lake) == [day("2024-01-01"), day("2024-01-03")]
    got = by(lake.silver("order_items_enriched"), "LINEITEM_ID")
    assert got["L1"]["ORDER_DATE"] == day("2024-01-03") and got["L1"]["LINE_REVENUE"] == D("22.00")
    assert set(got) == {"L1", "L2"}
    # a later load for the day it left does not bring it back
    shop.sell("L4", "D", "2024-01-03T11:00:00")
    jobs.ingest(shop.source(), lake, "2024-01-04")
    jobs.silver(lake, {1, 3})
    assert {k: r["ORDER_DATE"] for k, r in by(lake.silver("order_items_enriched"), "LINEITEM_ID").items()} == {
        "L1": day("2024-01-03"), "L2": day("2024-01-02"), "L4": day("2024-01-03"),
    }


def test_values_that_do_not_fit_are_set_aside_with_a_reason(lake, shop):
    shop.sell("L1", "A", "2024-01-01T10:00:00", extras=[("x", 2)])
    shop.sell("L2", "B", "2024-01-01T11:00:00")
    source = shop.source()

    def text(table):
        price = F.when(F.col("LINEITEM_ID") == "L2", "$9.50").otherwise(F.col("ITEM_PRICE").cast("string"))
        rows = source.read(table)
        return rows.withColumn("ITEM_PRICE", price) if table == "order_items" else rows

    batch = jobs.ingest(FrameSource(text), lake, "2024-01-01")
    for seen in (batch, lake.batches()[0]):
        assert (seen.rows["order_items"], seen.unparsed["order_items"]) == (1, 1)
    jobs.silver(lake)
    assert revenue(lake) == {"L1": D("12.00")}
    (bad,) = lake.unparsed("order_items").collect()
    assert (bad.LINEITEM_ID, bad.ITEM_PRICE, bad.batch_id, bad.REJECT_REASON) == ("L2", "$9.50", 1, "ITEM_PRICE is not decimal(10,2)")
    # once the source is mended, a replay takes the line in
    assert jobs.replay(source, lake, 1).unparsed["order_items"] == 0
    jobs.silver(lake)
    assert lake.unparsed("order_items").isEmpty() and revenue(lake) == {"L1": D("12.00"), "L2": D("10.00")}


def test_copies_inside_one_load_are_kept(lake, shop):
    shop.sell("L1", "A", "2024-01-01T10:00:00")
    shop.sell("L1", "A", "2024-01-01T10:00:00")
    jobs.ingest(shop.source(), lake, "2024-01-01")
    jobs.silver(lake)
    assert lake.silver("order_items_enriched").count() == 2


def test_crash_before_the_ledger_row(lake, shop, monkeypatch):
    shop.sell("L1", "A", "2024-01-01T10:00:00")

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Lake, "commit_batch", die)
        with pytest.raises(RuntimeError, match="lost"):
            jobs.ingest(shop.source(), lake, "2024-01-01")
    assert lake.batches() == [] and lake.watermark() == FLOOR_WATERMARK
    shop.sell("L2", "B", "2024-01-01T11:00:00")
    # next day: the files of the dead run stay under their own date and are never read
    jobs.ingest(shop.source(), lake, "2024-01-02")
    assert sorted(r.LINEITEM_ID for r in raw(lake).collect()) == ["L1", "L2"]


def test_replay_uses_the_bounds_of_the_batch(lake, shop):
    shop.sell("L1", "A", "2024-01-01T10:00:00")
    jobs.ingest(shop.source(), lake, "2024-01-01")
    shop.sell("L2", "B", "2024-01-02T10:00:00")
    jobs.ingest(shop.source(), lake, "2024-01-02")
    shop.items[0] = ("L1", "A", "u", "2024-01-01T10:00:00", 99, 1)
    batch = jobs.replay(shop.source(), lake, 1)
    assert batch.rows["order_items"] == 1 and lake.watermark().startswith("2024-01-02T10")
    jobs.silver(lake)
    assert revenue(lake) == {"L1": D("99.00"), "L2": D("10.00")}


def test_rejects_disappear_once_the_rows_are_fixed(lake, shop):
    shop.sell("L1", "A", "2024-01-01T10:00:00")
    shop.sell(None, "B", "2024-01-01T11:00:00")
    shop.options += [("A", "L1", "x", 1, 1)]
    jobs.ingest(shop.source(), lake, "2024-01-01")
    jobs.silver(lake)
    (bad,) = lake.rejects("order_items").collect()
    assert (bad.REJECT_REASON, bad.ORDER_ID, bad.batch_id) == ("LINEITEM_ID is NULL", "B", 1)
    assert lake.rejects("order_item_options").count() == 0
    shop.items[1] = ("L2", "B", "u", "2024-01-01T11:00:00", 1, 1)
    jobs.replay(shop.source(), lake, 1)
    jobs.silver(lake, {1})
    assert lake.rejects("order_items").count() == 0
    assert set(revenue(lake)) == {"L1", "L2"}


def test_orphans_are_judged_against_all_loads(lake, shop, spark):
    shop.sell("L1", "A", "2024-01-01T10:00:00")
    jobs.ingest(shop.source(), lake, "2024-01-01")
    jobs.silver(lake)
    # options of a line loaded earlier, and of none
    late = options(spark, [("A", "L1", "late", 3, 1), ("A", "L9", "lost", 3, 1)])
    land(lake, Batch(2, dt.date(2024, 1, 2), None, None, {}), order_item_options=late)
    jobs.silver(lake)
    assert [r.OPTION_NAME for r in lake.rejects("order_item_options").collect()] == ["lost"]


def test_unreadable_calendar_stops_silver_before_anything_is_published(lake, shop):
    shop.keys.append("2024/01/04")
    shop.sell("L1", "A", "2024-01-01T10:00:00")
    jobs.ingest(shop.source(), lake, "2024-01-01")
    with pytest.raises(ValueError, match="date_key"):
        jobs.silver(lake)
    with pytest.raises(LookupError):
        lake.silver("order_items_enriched")
    shop.keys.pop()
    jobs.ingest(shop.source(), lake, "2024-01-02")
    jobs.silver(lake)
    assert set(revenue(lake)) == {"L1"}


def land(lake, batch, **tables):
    for table, rows in tables.items():
        batch.rows[table] = lake.write_batch(rows, table, batch)
    lake.commit_batch(batch, f"by hand {batch.batch_id}")


def landed(lake, number, **tables):
    land(lake, Batch(number, dt.date(2024, 1, number), None, None, {}), **tables)
    return jobs.silver(lake)


def with_calendar(spark, **tables):
    return tables | {"date_dim": calendar(spark, ["01-01-2024"])}


def test_line_that_gets_a_time_leaves_the_day_without_one(lake, spark):
    first = items(spark, [("L1", "A", "u", None, 10, 1), ("L0", "A", "u", None, 1, 1)])
    landed(lake, 1, **with_calendar(spark, order_items=first))
    again = landed(lake, 2, order_items=items(spark, [("L1", "A", "u", "2024-01-01T10:00:00", 10, 1)]))
    assert again == [day("2024-01-01"), None]
    rows = sorted((r.LINEITEM_ID, r.ORDER_DATE) for r in lake.silver("order_items_enriched").collect())
    assert rows == [("L0", None), ("L1", day("2024-01-01"))]


def test_options_that_come_after_their_line_are_counted(lake, spark):
    landed(lake, 1, **with_calendar(spark, order_items=items(spark, [("L1", "A", "u", "2024-01-01T10:00:00", 10, 1)])))
    assert landed(lake, 2, order_item_options=options(spark, [("A", "L1", "x", 3, 1)])) == [day("2024-01-01")]
    assert revenue(lake) == {"L1": D("13.00")} and lake.rejects("order_item_options").isEmpty()
    jobs.silver(lake, {1})
    assert revenue(lake) == {"L1": D("13.00")}


def test_options_that_come_before_their_line_leave_the_rejects(lake, spark):
    given = [("A", "L1", "x", 3, 1), ("A", "L9", "lost", 1, 1)]
    landed(lake, 1, **with_calendar(spark, order_item_options=options(spark, given)))
    assert {r.LINEITEM_ID for r in lake.rejects("order_item_options").collect()} == {"L1", "L9"}
    landed(lake, 2, order_items=items(spark, [("L1", "A", "u", "2024-01-01T10:00:00", 10, 1)]))
    assert revenue(lake) == {"L1": D("13.00")}
    assert [r.LINEITEM_ID for r in lake.rejects("order_item_options").collect()] == ["L9"]
    # options in = options in silver and options rejected
    in_silver = lake.silver("order_items_enriched").agg(F.sum("NUM_OPTIONS")).first()[0]
    assert raw(lake, "order_item_options").count() == in_silver + lake.rejects("order_item_options").count()
    for batch in (1, 2):
        jobs.silver(lake, {batch})
        assert revenue(lake) == {"L1": D("13.00")} and lake.rejects("order_item_options").count() == 1


def test_row_that_left_the_source_goes_with_a_replay(lake, shop):
    shop.sell("L1", "A", "2024-01-01T10:00:00")
    shop.sell("L2", "B", "2024-01-02T10:00:00")
    jobs.ingest(shop.source(), lake, "2024-01-02")
    jobs.silver(lake)
    shop.items.pop(0)
    assert jobs.replay(shop.source(), lake, 1).rows["order_items"] == 1
    assert lake.batches()[0].rows["order_items"] == 1
    jobs.silver(lake)
    assert revenue(lake) == {"L2": D("10.00")}


def test_crash_during_a_replay_leaves_the_old_generation(lake, shop, monkeypatch):
    shop.sell("L1", "A", "2024-01-01T10:00:00")
    jobs.ingest(shop.source(), lake, "2024-01-01")
    shop.items.clear()

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Lake, "commit_batch", die)
        with pytest.raises(RuntimeError, match="lost"):
            jobs.replay(shop.source(), lake, 1)
    assert raw(lake).count() == 1 and lake.batches()[0].generation == 1
    jobs.silver(lake)
    assert set(revenue(lake)) == {"L1"}


def test_options_removed_at_the_source_are_no_longer_charged(lake, shop):
    shop.sell("L1", "A", "2024-01-01T10:00:00", extras=[("x", 3)])
    jobs.ingest(shop.source(), lake, "2024-01-01")
    jobs.silver(lake)
    assert revenue(lake) == {"L1": D("13.00")}
    shop.options.clear()
    shop.sell("L1", "A", "2024-01-01T11:00:00")
    jobs.ingest(shop.source(), lake, "2024-01-02")
    jobs.silver(lake)
    assert revenue(lake) == {"L1": D("10.00")}
    jobs.silver(lake, {1})
    assert revenue(lake) == {"L1": D("10.00")}


def test_second_writer_is_noticed(lake, shop):
    shop.sell("L1", "A", "2024-01-01T10:00:00")
    source = shop.source()
    late = Batch(1, dt.date(2024, 1, 1), FLOOR_WATERMARK, "2024-01-01T10:00:00.000000", {})
    jobs.ingest(source, lake, "2024-01-01")
    with pytest.raises(WriterConflict):
        land(lake, late, order_items=source.batch("order_items", late.lo, late.hi))
    stale = Batch(2, dt.date(2024, 1, 1), FLOOR_WATERMARK, "2024-01-01T10:00:00.000000", {})
    with pytest.raises(WriterConflict):
        land(lake, stale, order_items=source.batch("order_items", stale.lo, stale.hi))


def test_new_batches_read_no_earlier_raw_batch(lake, shop, monkeypatch):
    shop.sell("L1", "A", "2024-01-01T10:00:00")
    jobs.ingest(shop.source(), lake, "2024-01-01")
    jobs.silver(lake)
    shop.sell("L2", "B", "2024-01-01T11:00:00")
    jobs.ingest(shop.source(), lake, "2024-01-02")
    asked, read = [], Lake.read_batches

    def seen(self, table, batches=None):
        asked.append(batches and [b.batch_id for b in batches])
        return read(self, table, batches)

    monkeypatch.setattr(Lake, "read_batches", seen)
    jobs.silver(lake)
    assert asked and all(ids == [2] for ids in asked)
    text = read(lake, "order_items", lake.batches({2}))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "batch_id" in text[text.index("PartitionFilters") :]


def test_reports_are_versioned_together(lake, shop):
    shop.sell("L1", "A", "2024-01-01T10:00:00", extras=[("x", 2)])
    shop.sell("L2", "B", "2024-01-02T10:00:00", user=None)
    jobs.ingest(shop.source(), lake, "2024-01-02")
    jobs.silver(lake)
    assert jobs.gold(lake, "2024-04-05") == 1
    (clv,) = lake.report("clv").collect()
    assert (clv.USER_ID, clv.RUNNING_LTV, clv.CLV_TAG) == ("u", D("12.00"), "Low")
    (rfm,) = lake.report("rfm").collect()
    assert (rfm.RECENCY, rfm.IS_CHURNED) == (95, True)
    assert lake.report("daily_sales").count() == 2
    assert lake.report("location_perf").first().TOTAL_REVENUE == D("22.00")
    shop.sell("L3", "C", "2024-01-03T10:00:00")
    jobs.ingest(shop.source(), lake, "2024-01-03")
    jobs.silver(lake)
    assert jobs.gold(lake, "2024-01-04") == 2
    assert lake.report("daily_sales").count() == 3 and lake.report("daily_sales", 1).count() == 2


def test_two_loads_of_the_test_tables_equal_the_queries(lake, spark, small_data):
    tables = Tables(spark, small_data)
    early = tables.items.filter("CREATION_TIME_UTC <= timestamp'1999-06-15 00:00:00'")
    jobs.ingest(FrameSource({**tables.all, "order_items": early}.get), lake, "2001-08-01")
    jobs.silver(lake)
    jobs.ingest(FrameSource(tables.read), lake, "2001-08-02")
    jobs.silver(lake)
    jobs.gold(lake, REFERENCE_DATE)

    def same(published, name):
        want = registered()[name](spark, small_data)
        got = published.select([F.col(c).cast(t).alias(c) for c, t in want.dtypes])
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()

    enriched = lake.silver("order_items_enriched")
    same(enriched.withColumn("CREATION_TIME_UTC", watermark_text("CREATION_TIME_UTC")), "order_items_enriched")
    for report, name in {"clv": "clv", "rfm": "rfm_churn", "daily_sales": "daily_sales", "location_perf": "location_perf"}.items():
        same(lake.report(report), name)
    same(lake.silver("date_dim"), "parse_date_dim")
    # options are loaded by their line, so those without one never get this far
    assert lake.rejects("order_item_options").isEmpty()


# --- reports and silver by what has changed --------------------------------------------------------


def equal(got, want):
    got = got.select([F.col(c).cast(t).alias(c) for c, t in want.dtypes])
    return got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def assert_as_rebuilt(lake, reference):
    lines = lake.silver("order_items_enriched")
    whole = {
        "clv": customers.customer_value(lines),
        "rfm": customers.flag_churn(customers.rfm(lines, reference)),
        "daily_sales": sales.daily_sales(lines),
        "location_perf": sales.location_performance(lines),
    }
    for name, want in whole.items():
        assert equal(lake.report(name), want), name


def sell_many(shop, n=40):
    for i in range(n):
        extras = [("x", i % 3)] if i % 2 else []
        shop.sell(f"L{i}", f"O{i // 2}", f"2024-01-0{i % 3 + 1}T10:00:{i:02d}", price=i + 1, user=f"u{i % 7}" if i % 5 else None, extras=extras)


def load(lake, shop, date):
    batch = jobs.ingest(shop.source(), lake, date)
    return batch, jobs.silver(lake)


def test_reports_by_what_has_changed_equal_a_rebuild(lake, shop):
    sell_many(shop)
    load(lake, shop, "2024-01-03")
    jobs.gold(lake, "2024-04-05")
    assert_as_rebuilt(lake, "2024-04-05")
    # one line is moved and gets another customer, one order is spread over a further day, one line is new
    shop.sell("L4", "O2", "2024-01-04T09:00:00", price=500, user="new")
    shop.sell("L90", "O1", "2024-01-04T10:00:00", price=3, user="u1")
    shop.sell("L91", "O91", "2024-01-04T11:00:00", price=3, user=None)
    _, days = load(lake, shop, "2024-01-04")
    assert day("2024-01-04") in days and day("2024-01-03") not in days
    jobs.gold(lake, "2024-04-06")
    assert_as_rebuilt(lake, "2024-04-06")
    # a replay takes rows away again, and a customer with them
    shop.items = [row for row in shop.items if row[0] not in ("L90", "L7", "L14", "L21", "L28")]
    jobs.replay(shop.source(), lake, 1)
    jobs.replay(shop.source(), lake, 2)
    jobs.silver(lake)
    jobs.gold(lake, "2024-04-07")
    assert_as_rebuilt(lake, "2024-04-07")
    # with nothing new the reports stay, but for what depends on the day
    before = lake.published()
    assert jobs.gold(lake, "2024-05-01") == 4
    assert lake.days_since(before.silver_run) == []
    assert_as_rebuilt(lake, "2024-05-01")


def test_buckets_of_another_number_are_made_anew(lake, shop, spark):
    sell_many(shop, 12)
    load(lake, shop, "2024-01-03")
    jobs.gold(lake, "2024-04-05")
    other = Lake(spark, lake.root, buckets=3)
    shop.sell("L4", "O2", "2024-01-04T09:00:00", price=500)
    load(other, shop, "2024-01-04")
    jobs.gold(other, "2024-04-05")
    assert_as_rebuilt(other, "2024-04-05")
    shop.sell("L5", "O2", "2024-01-04T09:30:00", price=50)
    load(lake, shop, "2024-01-05")
    jobs.gold(lake, "2024-04-05")
    assert_as_rebuilt(lake, "2024-04-05")


@contextmanager
def unreadable(*paths):
    """Whoever reads one of these files fails."""
    held = {path: path.read_bytes() for path in paths}
    assert held
    for path in held:
        path.write_bytes(b"nothing to read here")
    yield
    for path, content in held.items():
        path.write_bytes(content)


def test_a_small_load_reads_touched_days_and_buckets_only(lake, shop, spark):
    sell_many(shop)
    load(lake, shop, "2024-01-03")
    jobs.gold(lake, "2024-04-05")

    def bucket(value):
        return spark.createDataFrame([(value,)], "v string").select(lake.in_bucket("v")).first()[0]

    def files(folder, keep=()):
        found = Path(lake.root, folder).rglob("*.parquet")
        return [f for f in found if not any(part in keep for part in f.parts)]

    silver_days = files("prod/order_items_enriched", keep=("day=2",))
    index = files("prod/line_index_4", keep=(f"bucket={bucket('L1')}",))
    people = [f for t in ("customer_orders_4", "customer_days_4") for f in files(f"state/{t}", keep=(f"bucket={bucket('u1')}",))]
    orders = [f for t in ("location_orders_4",) for f in files(f"state/{t}", keep=(f"bucket={bucket('O0')}",))]
    with unreadable(*silver_days, *index, *people, *orders, *files("raw/order_items"), *files("raw/order_item_options")):
        with pytest.raises(Exception, match="."):
            lake.silver("order_items_enriched").collect()
        # a landed line of the second day, which keeps its options
        again = items(spark, [("L1", "O0", "u1", "2024-01-02T23:00:00", 77, 1)])
        land(lake, Batch(lake.next_batch_id(), dt.date(2024, 1, 4), None, None, {}), order_items=again)
        assert jobs.silver(lake) == [day("2024-01-02")]
        jobs.gold(lake, "2024-04-05")
    assert revenue(lake)["L1"] == D("78.00") and lake.silver("order_items_enriched").count() == 40
    assert_as_rebuilt(lake, "2024-04-05")


def test_line_index_holds_every_line(lake, shop):
    sell_many(shop)
    load(lake, shop, "2024-01-03")
    shop.sell("L4", "O2", "2024-01-04T09:00:00")
    load(lake, shop, "2024-01-04")
    jobs.silver(lake, {1})
    index = lake.line_index([*range(4)])
    lines = lake.silver("order_items_enriched").select("LINEITEM_ID", "ORDER_ID", "ORDER_DATE", lake.in_bucket("LINEITEM_ID").alias("bucket"))
    assert equal(index, lines)


def test_tiers_over_time(lake, shop):
    for i in range(10):
        shop.sell(f"L{i}", f"O{i}", "2024-01-01T10:00:00", price=i + 1, user=f"u{i}")
    load(lake, shop, "2024-01-01")
    jobs.gold(lake, "2024-01-01")
    shop.sell("L10", "O10", "2024-01-02T10:00:00", price=100, user="u0")
    load(lake, shop, "2024-01-02")
    jobs.gold(lake, "2024-01-02")

    def told():
        return {(r.USER_ID, r.CLV_TAG, str(r.VALID_FROM), str(r.VALID_TO)) for r in lake.report("clv_tag_history").collect()}

    history = told()
    assert {("u0", "Low", "2024-01-01", "2024-01-02"), ("u0", "High", "2024-01-02", "None"), ("u9", "High", "2024-01-01", "None")} <= history
    assert {("u8", "High", "2024-01-01", "2024-01-02"), ("u8", "Med", "2024-01-02", "None")} <= history
    # the same run again, and one for an earlier day, leave the history as it is
    jobs.gold(lake, "2024-01-02")
    jobs.gold(lake, "2023-12-31")
    assert told() == history
    now = {(r.USER_ID, r.CLV_TAG) for r in lake.report("clv").select("USER_ID", "CLV_TAG").distinct().collect()}
    assert now == {(u, tag) for u, tag, _, upto in history if upto == "None"}
    assert {r[:2] for r in map(tuple, lake.report("clv_tag_history", 1).collect())} == {
        (f"u{i}", "Low" if i < 2 else "High" if i > 7 else "Med") for i in range(10)
    }


# --- several writers -------------------------------------------------------------------------------


def interleaved(monkeypatch, owner, step, other):
    """The first time ``step`` is reached, another writer does all of its work before it goes on."""
    real, done = getattr(owner, step), []

    def between(*args, **named):
        if not done:
            done.append(1)
            other()
        return real(*args, **named)

    monkeypatch.setattr(owner, step, between)
    return done


LOAD_STEPS = [(Lake, "write_batch"), (Lake, "commit_batch"), (lake_module, "rename_once")]


@pytest.mark.parametrize("owner, step", LOAD_STEPS, ids=[name for _, name in LOAD_STEPS])
def test_of_two_loads_at_once_one_is_seen(lake, shop, spark, monkeypatch, owner, step):
    shop.sell("L1", "A", "2024-01-01T10:00:00", extras=[("x", 2)])
    other = Lake(spark, lake.root, buckets=4)
    done = interleaved(monkeypatch, owner, step, lambda: jobs.ingest(shop.source(), other, "2024-01-01", run_id="other"))
    with pytest.raises(WriterConflict):
        jobs.ingest(shop.source(), lake, "2024-01-01", run_id="this")
    assert done
    assert [r.run_id for r in lake.ledger("batches").select("run_id").distinct().collect()] == ["other"]
    assert raw(lake).count() == 1 and raw(lake, "order_item_options").count() == 1
    # the loser tries again and finds nothing new
    assert jobs.ingest(shop.source(), lake, "2024-01-01").rows["order_items"] == 0
    jobs.silver(lake)
    assert revenue(lake) == {"L1": D("12.00")}


SILVER_STEPS = [(Lake, "claim"), (lake_module, "rename_once")]


@pytest.mark.parametrize("owner, step", SILVER_STEPS, ids=[name for _, name in SILVER_STEPS])
def test_of_two_silver_and_gold_runs_at_once_one_is_seen(lake, shop, spark, monkeypatch, owner, step):
    sell_many(shop, 6)
    jobs.ingest(shop.source(), lake, "2024-01-03")
    other = Lake(spark, lake.root, buckets=4)
    with monkeypatch.context() as patch:
        done = interleaved(patch, owner, step, lambda: jobs.silver(other))
        with pytest.raises(WriterConflict):
            jobs.silver(lake)
    assert done
    whole = [tuple(r) for r in lake.silver("order_items_enriched").collect()]
    assert len(whole) == 6 and jobs.silver(lake) == []
    with monkeypatch.context() as patch:
        interleaved(patch, owner, step, lambda: jobs.gold(other, "2024-04-05"))
        with pytest.raises(WriterConflict):
            jobs.gold(lake, "2024-04-06")
    assert str(lake.published().reference_date) == "2024-04-05"
    assert lake.report("daily_sales").count() == 3 and lake.report("clv").count() == 4


def test_replays_at_once_have_one_winner(lake, shop, spark, monkeypatch):
    shop.sell("L1", "A", "2024-01-01T10:00:00")
    jobs.ingest(shop.source(), lake, "2024-01-01")
    other = Lake(spark, lake.root, buckets=4)
    shop.items[0] = ("L1", "A", "u", "2024-01-01T10:00:00", 99, 1)
    interleaved(monkeypatch, Lake, "write_batch", lambda: jobs.replay(shop.source(), other, 1))
    with pytest.raises(WriterConflict):
        jobs.replay(shop.source(), lake, 1)
    assert [(b.batch_id, b.generation) for b in lake.batches()] == [(1, 3)]
    jobs.silver(lake)
    assert revenue(lake) == {"L1": D("99.00")}
