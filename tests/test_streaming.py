from decimal import Decimal as D

import pytest
from frames import items, options

from orderlake.plans import jobs
from orderlake.schemas import FLOOR_WATERMARK
from orderlake.sources.lake import Lake
from orderlake.streaming.landing import land_files


def test_each_landed_file_is_taken_once(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=4)
    drop = str(tmp_path / "items")
    items(spark, [("L1", "A", "u", "2024-01-01T10:00:00", 5, 1)]).write.mode("append").parquet(drop)
    assert land_files(lake, "order_items", drop, "2024-01-01") == 1
    assert land_files(lake, "order_items", drop, "2024-01-01") == 0
    items(spark, [("L2", "B", "u", "2024-01-02T10:00:00", 7, 1)]).write.mode("append").parquet(drop)
    assert land_files(lake, "order_items", drop, "2024-01-02") == 1
    extras = str(tmp_path / "options")
    options(spark, [("A", "L1", "x", 2, 1), ("Z", "L1", "y", 2, 1)]).write.parquet(extras)
    assert land_files(lake, "order_item_options", extras, "2024-01-02") == 1
    # files have no watermark, so a later database load is not shortened by them
    assert lake.watermark() == FLOOR_WATERMARK
    jobs.silver(lake)
    silver = lake.silver("order_items_enriched").collect()
    assert {r.LINEITEM_ID: r.LINE_REVENUE for r in silver} == {"L1": D("7.00"), "L2": D("7.00")}
    assert [r.OPTION_NAME for r in lake.rejects("order_item_options").collect()] == ["y"]


def test_landed_text_is_read_by_header_and_misfits_are_set_aside(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=4)
    drop = tmp_path / "options"
    drop.mkdir()
    header = "LINEITEM_ID,ORDER_ID,OPTION_GROUP_NAME,OPTION_NAME,OPTION_QUANTITY,OPTION_PRICE\n"
    (drop / "a.csv").write_text(header + "L1,A,g,x,2,9.50\nL2,A,g,y,1,$9.50\n")
    assert land_files(lake, "order_item_options", str(drop), "2024-01-01", "csv") == 1
    (row,) = lake.read_batches("order_item_options").collect()
    assert (row.ORDER_ID, row.LINEITEM_ID, row.OPTION_PRICE, row.OPTION_QUANTITY) == ("A", "L1", D("9.50"), 2)
    (bad,) = lake.unparsed("order_item_options").collect()
    assert (bad.LINEITEM_ID, bad.OPTION_PRICE, bad.REJECT_REASON) == ("L2", "$9.50", "OPTION_PRICE is not decimal(10,2)")
    (drop / "b.csv").write_text(header + "L3,B,g,z,1,1\n")
    assert land_files(lake, "order_item_options", str(drop), "2024-01-02", "csv") == 1
    assert {r.LINEITEM_ID for r in lake.read_batches("order_item_options").collect()} == {"L1", "L3"}
    assert [b.unparsed["order_item_options"] for b in lake.batches()] == [1, 0]


def test_repeated_micro_batch_is_committed_once(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=4)
    drop = str(tmp_path / "items")
    items(spark, [("L1", "A", "u", "2024-01-01T10:00:00", 5, 1)]).write.parquet(drop)
    commit = Lake.commit_batch

    def commit_and_die(self, batch, run_id):
        commit(self, batch, run_id)
        raise RuntimeError("lost after the ledger row")

    with monkeypatch.context() as patch:
        patch.setattr(Lake, "commit_batch", commit_and_die)
        try:
            land_files(lake, "order_items", drop, "2024-01-01")
            raise AssertionError("the run should have failed")
        except Exception as error:
            assert "lost after the ledger row" in str(error)
    assert land_files(lake, "order_items", drop, "2024-01-01") == 0
    assert lake.read_batches("order_items", lake.batches()).count() == 1


def test_stream_goes_through_silver_and_keeps_early_options_open(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=4)
    lines, extras = str(tmp_path / "items"), str(tmp_path / "options")
    options(spark, [("A", "L1", "x", 2, 1), ("A", "L2", "y", 3, 1)]).write.parquet(extras)
    assert land_files(lake, "order_item_options", extras, "2024-01-01", publish=True) == 1
    assert {r.LINEITEM_ID for r in lake.rejects("order_item_options").collect()} == {"L1", "L2"}
    items(spark, [("L1", "A", "u", "2024-01-01T10:00:00", 5, 1)]).write.mode("append").parquet(lines)
    assert land_files(lake, "order_items", lines, "2024-01-01", publish=True) == 1
    # one option has found its line, the other waits for the next trigger
    assert [r.LINEITEM_ID for r in lake.rejects("order_item_options").collect()] == ["L2"]
    items(spark, [("L2", "A", "u", "2024-01-02T10:00:00", 7, 1)]).write.mode("append").parquet(lines)
    assert land_files(lake, "order_items", lines, "2024-01-02", publish=True) == 1
    assert {r.LINEITEM_ID: r.LINE_REVENUE for r in lake.silver("order_items_enriched").collect()} == {"L1": D("7.00"), "L2": D("10.00")}
    assert lake.rejects("order_item_options").isEmpty()


def test_crash_between_landing_and_silver(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=4)
    drop = str(tmp_path / "items")
    items(spark, [("L1", "A", "u", "2024-01-01T10:00:00", 5, 1)]).write.parquet(drop)

    def die(*_):
        raise RuntimeError("lost before silver")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "silver", die)
        with pytest.raises(Exception, match="lost before silver"):
            land_files(lake, "order_items", drop, "2024-01-01", publish=True)
    assert len(lake.batches()) == 1 and lake.silver_run() == 0
    # the same micro-batch comes again: not landed twice, but published
    assert land_files(lake, "order_items", drop, "2024-01-01", publish=True) == 0
    assert lake.silver("order_items_enriched").count() == 1 == lake.silver_run()


def test_json_misfits_and_broken_lines_are_set_aside(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=4)
    drop = tmp_path / "options"
    drop.mkdir()
    good = '{"ORDER_ID": "A", "LINEITEM_ID": "L1", "OPTION_PRICE": 9.50, "OPTION_QUANTITY": 2, "more": [1]}'
    misfit = '{"ORDER_ID": "A", "LINEITEM_ID": "L2", "OPTION_PRICE": "$9.50", "OPTION_QUANTITY": 1}'
    (drop / "a.json").write_text("\n".join([good, "", misfit, '{"ORDER_ID": "A", ', "12", good.replace("L1", "L3")]))
    assert land_files(lake, "order_item_options", str(drop), "2024-01-01", "json") == 1
    rows = {r.LINEITEM_ID: (r.OPTION_PRICE, r.OPTION_QUANTITY) for r in lake.read_batches("order_item_options").collect()}
    assert rows == {"L1": (D("9.50"), 2), "L3": (D("9.50"), 2)}
    bad = sorted((r.LINEITEM_ID or "", r.REJECT_REASON) for r in lake.unparsed("order_item_options").collect())
    assert bad == [
        ("", "line is not an object: 12"), ("", 'line is not an object: {"ORDER_ID": "A", '), ("L2", "OPTION_PRICE is not decimal(10,2)"),
    ]
    assert (lake.batches()[0].rows, lake.batches()[0].unparsed) == ({"order_item_options": 2}, {"order_item_options": 3})
