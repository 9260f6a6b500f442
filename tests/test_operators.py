import datetime as dt
from decimal import Decimal as D

import pytest
from frames import by, calendar, day, items, lines, options

from orderlake.operators import customers, enrich, incremental, profile, quality, sales
from orderlake.schemas import LINE_KEY, LOADS, LoadSpec

LINE = "USER_ID string, ORDER_ID string, ORDER_DATE date, LINE_REVENUE decimal(32,2)"


def test_line_without_options_keeps_its_own_price(spark):
    own = items(spark, [("L1", "A", "u", None, 5, 1), ("L2", "A", "u", None, 10, 2)])
    rolled = enrich.roll_up_options(options(spark, [("A", "L2", "x", 3, 1)]))
    got = by(enrich.line_revenue(own, rolled), "LINEITEM_ID")
    assert got["L1"]["LINE_REVENUE"] == D("5.00") and got["L1"]["NUM_OPTIONS"] is None
    assert got["L2"]["LINE_REVENUE"] == D("23.00")


def test_options_roll_up(spark):
    (row,) = enrich.roll_up_options(
        options(spark, [("A", "L1", "x", 40, 2), ("A", "L1", "y", 10, 5)])
    ).collect()
    assert (row.TOTAL_OPTIONS_PRICE, row.NUM_OPTIONS) == (D("130.00"), 2)


def test_options_without_price_count_as_nothing_but_are_reported(spark):
    rows = options(spark, [("A", "L1", "x", None, 2), ("A", "L2", "y", 1, None), ("A", "L2", "z", 2, 1)])
    rolled = by(enrich.roll_up_options(rows), "LINEITEM_ID")
    assert rolled["L1"]["TOTAL_OPTIONS_PRICE"] is None
    assert rolled["L2"]["TOTAL_OPTIONS_PRICE"] == D("2.00")
    own = items(spark, [("L1", "A", "u", None, 5, 1)])
    (row,) = enrich.line_revenue(own, enrich.roll_up_options(rows)).collect()
    assert row.LINE_REVENUE == D("5.00")
    reasons = by(quality.corrupt_options(rows), "OPTION_NAME")
    assert {k: r["REJECT_REASON"] for k, r in reasons.items()} == {
        "x": "OPTION_PRICE is NULL",
        "y": "OPTION_QUANTITY is NULL",
    }


def test_line_without_price_has_no_revenue(spark):
    own = items(spark, [("L1", "A", "u", None, None, 1)])
    (row,) = enrich.line_revenue(own, enrich.roll_up_options(options(spark, []))).collect()
    assert row.LINE_REVENUE is None


def test_both_date_spellings(spark):
    keys = ["30-01-2022", "4/30/26", "nonsense", "2022-01-30"]
    got = by(enrich.parse_calendar(calendar(spark, keys)), "date_key")
    assert got["30-01-2022"]["DATE"] == dt.date(2022, 1, 30)
    assert got["4/30/26"]["DATE"] == dt.date(2026, 4, 30)
    assert got["nonsense"]["DATE"] is None and got["2022-01-30"]["DATE"] is None
    with pytest.raises(ValueError, match="2 date_key"):
        quality.require_parsed_dates(enrich.parse_calendar(calendar(spark, keys)))


def test_order_date_is_taken_in_utc(spark):
    rows = items(spark, [("L1", "A", "u", "2024-03-01T23:59:59.5", 1, 1), ("L2", "A", "u", None, 1, 1)])
    got = by(enrich.add_order_date(rows), "LINEITEM_ID")
    assert got["L1"]["ORDER_DATE"] == day("2024-03-01")
    assert (got["L1"]["year"], got["L1"]["month"], got["L1"]["day"]) == (2024, 3, 1)
    assert got["L2"]["ORDER_DATE"] is None and got["L2"]["year"] is None


def test_corrupt_lines_name_every_missing_column(spark):
    rows = items(spark, [("L1", "A", "u", None, 1, 1), (None, None, "u", None, 1, 1), (None, "B", "u", None, 1, 1)])
    required = ["ORDER_ID", "LINEITEM_ID"]
    assert quality.valid_items(rows, required).count() == 1
    reasons = sorted(r.REJECT_REASON for r in quality.corrupt_items(rows, required).collect())
    assert reasons == ["LINEITEM_ID is NULL", "ORDER_ID is NULL, LINEITEM_ID is NULL"]


def test_null_keys_are_orphans(spark):
    own = items(spark, [("L1", "A", "u", None, 1, 1), ("L1", "A", "u", None, 1, 1), ("L2", None, "u", None, 1, 1)])
    opts = options(spark, [("A", "L1", "x", 1, 1), ("B", "L1", "y", 1, 1), (None, "L2", "z", 1, 1), (None, None, "w", 1, 1)])
    valid = quality.valid_items(own)
    assert [r.OPTION_NAME for r in quality.valid_options(opts, valid).collect()] == ["x"]
    orphans = quality.orphan_options(opts, valid)
    assert sorted(r.OPTION_NAME for r in orphans.collect()) == ["w", "y", "z"]
    (n,) = quality.conservation({"o": (opts, quality.judged_options(opts, valid))}).collect()
    assert (n.n_in, n.n_valid, n.n_rejected) == (4, 1, 3)
    assert by(quality.lines_without_options(valid, opts), "LINEITEM_ID").keys() == {"L2"}


def test_empty_text_is_not_a_key(spark):
    rows = spark.createDataFrame([("a",), ("",), (None,), ("  ",)], "k string")
    assert quality.nonempty(rows, "k").count() == 2
    assert quality.nonempty(rows, "k", blank_is_empty=True).count() == 1


def test_daily_spend_and_running_value(spark):
    rows = [
        ("u1", "A", day("2024-01-01"), 220.0),
        ("u1", "B", day("2024-01-02"), 50.0),
        ("u1", "C", day("2024-01-05"), 100.0),
        ("u1", "C", day("2024-01-05"), 25.0),
        (None, "D", day("2024-01-05"), 99.0),
    ]
    got = customers.daily_spend(lines(spark, rows, LINE)).orderBy("SNAPSHOT_DATE").collect()
    assert [r.RUNNING_LTV for r in got] == [D("220.00"), D("270.00"), D("395.00")]
    assert got[2].DAILY_SPEND == D("125.00")


DAILY = "USER_ID string, SNAPSHOT_DATE date, DAILY_SPEND decimal(38,2), RUNNING_LTV decimal(38,2)"


def test_quintiles_of_two_customers_and_refunds(spark):
    rows = [
        ("a", day("2024-01-01"), 10.0, 10.0),
        ("b", day("2024-01-01"), 90.0, 90.0),
        ("b", day("2024-01-02"), -85.0, 5.0),
    ]
    daily = lines(spark, rows, DAILY)
    got = by(customers.customer_quintile(daily), "USER_ID")
    assert {u: r["QUINTILE"] for u, r in got.items()} == {"a": 1, "b": 2}
    assert got["b"]["LATEST_LTV"] == D("90.00")
    safe = by(customers.customer_quintile(daily, refund_safe=True), "USER_ID")
    assert {u: r["QUINTILE"] for u, r in safe.items()} == {"a": 2, "b": 1}


def test_tiers_reach_every_daily_row(spark):
    rows = [(u, day(d), 1.0, 1.0) for u in "abc" for d in ("2024-01-01", "2024-01-02")]
    rows.append(("unranked", day("2024-01-01"), 1.0, 1.0))
    ranked = spark.createDataFrame([("a", 5), ("b", 1), ("c", 3)], "USER_ID string, QUINTILE int")
    got = customers.tag_daily(lines(spark, rows, DAILY), ranked)
    assert got.columns == ["USER_ID", "SNAPSHOT_DATE", "DAILY_SPEND", "RUNNING_LTV", "CLV_TAG"]
    tags = {}
    for r in got.collect():
        tags.setdefault(r.USER_ID, []).append(r.CLV_TAG)
    assert tags == {"a": ["High"] * 2, "b": ["Low"] * 2, "c": ["Med"] * 2, "unranked": [None]}


def test_rfm_and_churn(spark):
    rows = [
        ("u1", "A", day("2024-01-01"), 100.0),
        ("u1", "A", day("2024-01-01"), 30.0),
        ("u1", "B", day("2024-01-04"), 50.0),
        ("u2", "C", day("2023-10-12"), 1.0),
        ("u3", "D", day("2023-10-11"), 1.0),
        ("u4", "E", day("2024-02-01"), 1.0),
        (None, "F", day("2024-01-04"), 9.0),
    ]
    scores = customers.rfm(lines(spark, rows, LINE), "2024-01-10")
    got = by(customers.flag_churn(scores), "USER_ID")
    assert set(got) == {"u1", "u2", "u3", "u4"}
    assert (got["u1"]["FREQUENCY"], got["u1"]["MONETARY"], got["u1"]["RECENCY"]) == (2, D("180.00"), 6)
    assert (got["u2"]["RECENCY"], got["u2"]["IS_CHURNED"]) == (90, False)
    assert (got["u3"]["RECENCY"], got["u3"]["IS_CHURNED"]) == (91, True)
    assert got["u4"]["RECENCY"] == -22
    with pytest.raises(ValueError):
        customers.rfm(lines(spark, rows, LINE), "soon")


def test_daily_sales_keep_guests(spark):
    rows = [
        ("u1", "A", day("2024-01-01"), 100.0),
        ("u1", "A", day("2024-01-01"), 30.0),
        (None, "B", day("2024-01-01"), 50.0),
        ("u1", None, day("2024-01-02"), 5.0),
    ]
    frame = lines(spark, rows, LINE)
    for shape in (frame, sales.order_slices(frame, "USER_ID", "ORDER_DATE")):
        got = by(sales.daily_sales(shape), "ORDER_DATE")
        first = got[day("2024-01-01")]
        assert (first["TOTAL_REVENUE"], first["NUM_ORDERS"], first["NUM_LINE_ITEMS"], first["AOV"]) == (
            D("180.00"), 2, 3, D("90.00"),
        )
        # no order id at all: revenue without an average
        assert got[day("2024-01-02")]["NUM_ORDERS"] == 0 and got[day("2024-01-02")]["AOV"] is None


def test_locations_count_orders_each(spark):
    schema = "RESTAURANT_ID string, ORDER_ID string, LINE_REVENUE decimal(32,2)"
    rows = [("R1", "A", 100.0), ("R1", "B", 80.0), ("R2", "A", 40.0)]
    got = by(sales.location_performance(lines(spark, rows, schema)), "RESTAURANT_ID")
    assert (got["R1"]["TOTAL_REVENUE"], got["R1"]["NUM_ORDERS"], got["R1"]["AOV"]) == (D("180.00"), 2, D("90.00"))
    assert (got["R2"]["TOTAL_REVENUE"], got["R2"]["AOV"]) == (D("40.00"), D("40.00"))


def test_equal_revenue_shares_a_rank(spark):
    schema = "RESTAURANT_ID string, ORDER_ID string, LINE_REVENUE decimal(32,2)"
    rows = [("R1", "A", 5.0), ("R2", "B", 9.0), ("R3", "C", 5.0), ("R4", "D", 1.0), ("R5", "E", None), ("R6", "F", None)]
    got = by(sales.location_rank(lines(spark, rows, schema)), "RESTAURANT_ID")
    assert {k: r["REVENUE_RANK"] for k, r in got.items()} == {"R2": 1, "R1": 2, "R3": 2, "R4": 4, "R5": 5, "R6": 5}


def test_guests_share_one_running_total(spark):
    schema = "USER_ID string, LINEITEM_ID string, ORDER_DATE date, LINE_REVENUE decimal(32,2)"
    rows = [
        (None, "1", day("2024-01-01"), 1.0),
        (None, "2", day("2024-01-01"), 2.0),
        (None, "3", day("2024-01-02"), 4.0),
        ("u", "4", day("2024-01-02"), 8.0),
        ("u", "5", None, 16.0),
    ]
    got = by(customers.line_running_value(lines(spark, rows, schema)), "LINEITEM_ID")
    assert {k: r["RUNNING_LTV"] for k, r in got.items()} == {
        "1": 3, "2": 3, "3": 7, "4": 24, "5": 16,
    }


def test_value_as_of_is_carried_forward(spark):
    rows = [("a", day("2024-01-05"), 10.0, 10.0), ("a", day("2024-01-20"), 5.0, 15.0), ("b", day("2024-02-01"), 1.0, 1.0)]
    got = by(customers.value_as_of(lines(spark, rows, DAILY), "2024-01-04", "2024-01-05", "2024-01-31", "2024-02-01"), "USER_ID", "AS_OF")
    assert {k: r["VALUE"] for k, r in got.items()} == {
        ("a", day("2024-01-05")): 10,
        ("a", day("2024-01-31")): 15,
        ("a", day("2024-02-01")): 15,
        ("b", day("2024-02-01")): 1,
    }


def test_gaps_and_trend(spark):
    rows = [
        ("a", "1", day("2024-01-01"), 1.0),
        ("a", "2", day("2024-01-02"), 2.0),
        ("a", "3", day("2024-01-08"), 4.0),
        ("a", "4", day("2024-01-09"), 8.0),
        ("b", "5", day("2023-07-15"), 3.0),
    ]
    frame = lines(spark, rows, LINE)
    gaps = by(customers.order_gaps(frame, "2024-01-10"), "USER_ID")
    assert (gaps["a"]["DAYS_SINCE_LAST"], gaps["a"]["MEAN_GAP_DAYS"]) == (1, D("2.667"))
    assert gaps["b"]["MEAN_GAP_DAYS"] is None
    trend = by(customers.spend_trend(frame, "2024-01-10", days=5), "USER_ID")
    assert (trend["a"]["LAST_SPEND"], trend["a"]["PREVIOUS_SPEND"], trend["a"]["SPEND_CHANGE"]) == (12, 3, 9)
    assert trend["b"]["SPEND_CHANGE"] == 0


def test_load_rules(spark):
    own = items(spark, [("L1", "A", "u", "2024-01-01T00:00:00", 1, 1), ("L2", "A", "u", "2024-01-02T00:00:00", 1, 1), ("L3", "A", "u", None, 1, 1)])
    tables = {
        "order_items": own,
        "order_item_options": options(spark, [("A", "L1", "x", 1, 1), ("A", "L2", "y", 1, 1), ("B", "L2", "z", 1, 1)]),
        "date_dim": calendar(spark, ["01-01-2024"]),
    }
    lo = "2024-01-01T00:00:00"
    got = incremental.select_batch("order_items", tables.get, lo)
    assert [r.LINEITEM_ID for r in got.collect()] == ["L2"]
    got = incremental.select_batch("order_item_options", tables.get, lo)
    assert [r.OPTION_NAME for r in got.collect()] == ["y"]
    assert incremental.select_batch("date_dim", tables.get, lo).count() == 1
    for table in LOADS:
        incremental.select_batch(table, tables.get, lo, "2024-01-01T12:00:00")
    with pytest.raises(ValueError, match="no load rule"):
        incremental.select_batch("secrets", tables.get, lo)
    with pytest.raises(ValueError, match="unknown load strategy"):
        incremental.select_batch("x", tables.get, lo, loads={"x": LoadSpec("sometimes")})
    with pytest.raises(ValueError):
        incremental.select_batch("order_items", tables.get, "1' OR '1'='1")


def test_newest_version_wins_and_copies_inside_it_stay(spark):
    rows = [("k", 1, "a"), ("k", 2, "b"), ("k", 2, "b"), ("m", 1, "c"), (None, 1, "d")]
    frame = spark.createDataFrame(rows, "id string, batch_id bigint, v string")
    got = incremental.newest_per_key(frame, ["id"], "batch_id")
    assert sorted(r.v for r in got.collect()) == ["b", "b", "c", "d"]


def test_profiles(spark):
    frame = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("a", 2, None)], "x string, y int, z date")
    cols = by(profile.column_profile({"t": frame}), "COLUMN_NAME")
    assert (cols["x"]["NUM_DISTINCT"], cols["x"]["IS_CONSTANT"]) == (1, True)
    assert (cols["y"]["NUM_DISTINCT"], cols["y"]["NUM_NULLS"]) == (2, 0)
    assert (cols["z"]["NUM_DISTINCT"], cols["z"]["NUM_NULLS"], cols["z"]["IS_CONSTANT"]) == (0, 3, False)
    assert profile.duplicate_rows({"t": frame}).first().NUM_DUPLICATES == 1
    assert profile.repeated_keys(frame, ["x", "y"]).first().NUM_ROWS == 2
    assert LINE_KEY == ["ORDER_ID", "LINEITEM_ID"]


def test_discounts_are_negative_prices(spark):
    rows = options(spark, [("A", "L1", "x", -1.5, 2), ("A", "L1", "y", 0, 1), ("A", "L2", "z", 3, 1)])
    row = sales.discounts(rows).first()
    assert (row.NUM_DISCOUNTS, row.TOTAL_DISCOUNT) == (1, D("-3.00"))
    none = sales.discounts(rows.filter("OPTION_PRICE > 0")).first()
    assert (none.NUM_DISCOUNTS, none.TOTAL_DISCOUNT) == (0, 0)


def test_days_the_calendar_lacks(spark):
    rows = [("u", "A", day("2024-01-01"), 1.0), ("u", "B", day("2024-01-02"), 2.0), ("u", "B", day("2024-01-02"), 2.0)]
    frame = lines(spark, rows, LINE)
    known = enrich.parse_calendar(calendar(spark, ["01-01-2024", "03-01-2024"]))
    assert [r.ORDER_DATE for r in sales.join_calendar(frame, known).collect()] == [day("2024-01-01")]
    kept = sales.join_calendar(frame, known, "left")
    assert kept.count() == 3 and kept.filter("day_of_week IS NULL").count() == 2
    (missing,) = sales.missing_days(frame, known).collect()
    assert (missing.ORDER_DATE, missing.NUM_LINE_ITEMS) == (day("2024-01-02"), 2)
    assert sales.sales_calendar(frame, known).count() == 1


def test_lookups(spark):
    opts = options(spark, [("A", "L1", "x", 1, 1), ("A", "L2", "y", 1, 1), ("B", "L1", "z", 1, 1)])
    assert sales.of_order_line(opts, "A").count() == 2
    (row,) = sales.of_order_line(opts, "A", "L1").collect()
    assert row.OPTION_NAME == "x"
    frame = lines(spark, [("u", "A", day("2024-01-01"), 1.0)], LINE)
    assert sales.on_order_day(frame, "2024-01-01").count() == 1
    one = customers.daily_spend(frame.filter("USER_ID = 'u'")).orderBy("SNAPSHOT_DATE")
    assert one.first().RUNNING_LTV == 1
