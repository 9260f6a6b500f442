"""Plans: what must not meet in one task, what must reach the scan, and how hot keys are split."""

import pytest
from pyspark.sql import functions as F

from orderlake.operators import customers, enrich, incremental, once, quality, sales
from orderlake.plans.queries import Tables, registered
from orderlake.sources.sinks import replace_partitions

# queries whose result, or last step, is a single row or one row per partition or table
ONE_ROW = {"batch_watermark", "discounts", "row_counts", "null_profile", "duplicate_rows"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registered()) - ONE_ROW))
def test_no_query_gathers_its_rows_in_one_partition(spark, small_data, name):
    text = plan(registered()[name](spark, small_data))
    assert "SinglePartition" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text


def _steps(text, step):
    return sum(step in line for line in text.splitlines())


@pytest.mark.parametrize(
    "tiled, plain",
    [("clv", "daily_spend_ltv"), ("rfm_scores", "rfm"), ("customer_quintile", "clv_latest_refund_safe"), ("clv_tag_migration", None)],
)
def test_tiers_are_set_without_a_shuffle_or_join(spark, small_data, tiled, plain):
    queries = registered()
    text = plan(queries[tiled](spark, small_data))
    assert "RDD" not in text, "the plan has to begin at the files"
    if plain is None:
        # one grouping by customer, one by pair of tiers
        text, base = plan(queries[tiled](spark, small_data)), plan(queries["daily_spend_ltv"](spark, small_data))
        assert _steps(text, "Join") == _steps(base, "Join") and _steps(text, "Exchange") <= _steps(base, "Exchange") + 1
        return
    base = plan(queries[plain](spark, small_data))
    assert _steps(text, "Exchange") == _steps(base, "Exchange") > 0
    assert _steps(text, "Join") == _steps(base, "Join") > 0
    assert _steps(text, "Scan parquet") == _steps(base, "Scan parquet") > 0


def test_scans_read_the_columns_they_need(spark, small_data):
    text = plan(Tables(spark, small_data).options.select("OPTION_PRICE"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in text
    day = plan(registered()["scan_partition"](spark, small_data))
    assert "GreaterThanOrEqual(o_orderdate" in day


def test_null_checks_reach_the_scan(spark, small_data):
    orders = spark.read.parquet(f"{small_data}/orders.parquet")
    keys = ["o_orderkey", "o_custkey"]
    assert "IsNotNull(o_orderkey), IsNotNull(o_custkey)" in plan(quality.valid_items(orders, keys))
    assert "Or(IsNull(o_orderkey),IsNull(o_custkey))" in plan(quality.corrupt_items(orders, keys))


def hot_lines(spark, n=120_000):
    """Lines of which a third share one key, wide enough to weigh something."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, n, 1, 8).select(
        F.when(hot, "OX").otherwise(F.concat(F.lit("O"), "id")).alias("ORDER_ID"),
        F.when(hot, "LX").otherwise(F.concat(F.lit("L"), "id")).alias("LINEITEM_ID"),
        F.sha2(F.col("id").cast("string"), 256).alias("ITEM_NAME"),
        F.lit(2).cast("decimal(10,2)").alias("ITEM_PRICE"),
        F.lit(1).alias("ITEM_QUANTITY"),
    )


def hot_options(spark, n=120_000):
    hot = F.col("id") % 3 == 0
    return spark.range(0, n, 1, 8).select(
        F.when(hot, "OX").otherwise(F.concat(F.lit("O"), "id")).alias("ORDER_ID"),
        F.when(hot, "LX").otherwise(F.concat(F.lit("L"), "id")).alias("LINEITEM_ID"),
        F.sha2(F.col("id").cast("string"), 256).alias("OPTION_NAME"),
        F.lit(1).cast("decimal(10,2)").alias("OPTION_PRICE"),
        F.lit(1).alias("OPTION_QUANTITY"),
    )


@pytest.fixture
def shuffled(settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="40",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
    )


def test_hot_line_is_split_when_options_are_attached(spark, shuffled):
    joined = enrich.line_revenue(hot_lines(spark), enrich.roll_up_options(hot_options(spark)))
    result = joined.agg(F.sum("LINE_REVENUE").alias("s"), F.max("ITEM_NAME").alias("m"))
    # 80,000 lines of 2 + 1, and 40,000 lines of 2 + 40,000
    assert result.collect()[0].s == 80_000 * 3 + 40_000 * 40_002
    assert "skew=true" in plan(result)


@pytest.mark.parametrize("kept", [quality.valid_options, quality.orphan_options])
def test_hot_line_is_split_when_options_are_checked(spark, shuffled, kept):
    options = hot_options(spark)
    lines = hot_lines(spark).filter("ORDER_ID <> 'O1'")
    found = kept(options, lines).agg(F.count(F.lit(1)).alias("n"), F.max("OPTION_NAME").alias("m"))
    assert found.collect()[0].n == (119_999 if kept is quality.valid_options else 1)
    assert "skew=true" in plan(found)


def test_guests_and_one_large_customer_are_split(spark, shuffled):
    n = 120_000
    lines = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 1, "big").when(F.col("id") % 3 == 2, F.concat(F.lit("u"), "id")).alias("USER_ID"),
        F.lit("2024-01-01").cast("date").alias("ORDER_DATE"),
        F.sha2(F.col("id").cast("string"), 256).alias("LINEITEM_ID"),
        F.lit(1).cast("decimal(12,2)").alias("LINE_REVENUE"),
    )
    result = customers.line_running_value(lines).groupBy("RUNNING_LTV").agg(
        F.count(F.lit(1)).alias("n"), F.max("LINEITEM_ID").alias("m")
    )
    assert {(r.RUNNING_LTV, r.n) for r in result.collect()} == {(n // 3, 2 * n // 3), (1, n // 3)}
    text = plan(result)
    assert "skew=true" in text
    # what enters the window are daily sums
    window = text[text.index("Window [") :]
    assert "HashAggregate" in window[: window.index("Range")]


def test_hot_key_is_split_when_the_newest_version_is_kept(spark, shuffled):
    lines = hot_lines(spark).withColumn("batch_id", F.lit(3).cast("bigint"))
    kept = incremental.newest_per_key(lines, ["LINEITEM_ID"], "batch_id")
    result = kept.agg(F.count(F.lit(1)).alias("n"), F.max("ITEM_NAME").alias("m"))
    assert result.collect()[0].n == 120_000
    assert "skew=true" in plan(result)


def test_hot_line_is_split_when_its_load_is_selected(spark, shuffled):
    created = F.lit("2024-01-02").cast("timestamp").alias("CREATION_TIME_UTC")
    tables = {"order_items": hot_lines(spark).select("*", created), "order_item_options": hot_options(spark)}
    batch = incremental.select_batch("order_item_options", tables.get, "2024-01-01")
    result = batch.agg(F.count(F.lit(1)).alias("n"), F.max("OPTION_NAME").alias("m"))
    assert result.collect()[0].n == 120_000
    assert "skew=true" in plan(result)


def test_hot_day_is_written_by_several_tasks(spark, settings, tmp_path):
    settings(
        spark__sql__shuffle__partitions="20",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="200KB",
    )
    rows = spark.range(0, 90_000, 1, 8).select(
        F.lit(2024).alias("year"),
        F.lit(1).alias("month"),
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 28 + 1).cast("int").alias("day"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    path = replace_partitions(rows, str(tmp_path / "t"))
    back = spark.read.parquet(path)
    assert back.count() == 90_000
    files = back.withColumn("f", F.input_file_name()).groupBy("day").agg(F.count_distinct("f").alias("n"))
    counts = {r.day: r.n for r in files.collect()}
    assert counts[1] > 5 and max(n for d, n in counts.items() if d != 1) <= 3


def test_gold_slices_shrink_what_is_shuffled_again(spark, small_data):
    silver = Tables(spark, small_data).silver
    slices = sales.order_slices(silver, "USER_ID", "RESTAURANT_ID", "ORDER_DATE")
    assert slices.count() <= silver.count()


def test_customers_are_joined_to_orders_and_not_to_lines(spark, small_data, shuffled):
    text = plan(Tables(spark, small_data).items)
    lines = [line for line in text.splitlines() if "Exchange hashpartitioning(o_custkey" in line]
    assert len(lines) == 1
    below = text[text.index(lines[0]) :]
    assert "orders.parquet" in below and below.index("orders.parquet") < (below + "lineitem.parquet").index("lineitem.parquet")


@pytest.mark.parametrize("name", ["clv", "rfm_scores", "customer_quintile", "clv_tag_migration", "clv_tag_history", "location_rank"])
def test_tiled_rows_of_large_tables_are_computed_once(spark, small_data, monkeypatch, tmp_path, name):
    want = registered()[name](spark, small_data).collect()
    monkeypatch.setattr(once, "_folder", lambda spark: str(tmp_path))
    monkeypatch.setattr(once, "LARGE", 1)
    got = registered()[name](spark, small_data)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want), key=repr)
    text = plan(got)
    assert "lineitem.parquet" not in text and str(tmp_path) in text


def test_subtotals_make_no_rows_per_order_and_subset(spark, small_data):
    text = plan(registered()["revenue_cube"](spark, small_data))
    # cells are made of sums over all orders
    assert text.index("Generate inline") < text.index("Window [")


def test_rows_that_differ_in_where_a_null_is_are_not_equal(spark):
    from orderlake.operators import profile

    rows = [("a", None), (None, "a"), ("a", None), ("", "a"), ("aa", ""), ("a", "a")]
    assert profile.duplicate_rows({"t": spark.createDataFrame(rows, "x string, y string")}).first().NUM_DUPLICATES == 1
    text = plan(profile.duplicate_rows({"t": spark.createDataFrame(rows, "x string, y string")}))
    assert "hashpartitioning(x" not in text
