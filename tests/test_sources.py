import datetime as dt
from decimal import Decimal as D

import pytest
from frames import items, options
from pyspark.sql import functions as F

from orderlake.functions.columns import as_timestamp
from orderlake.operators import enrich, incremental
from orderlake.schemas import FLOOR_WATERMARK, LINE_KEY
from orderlake.sources import files, jdbc, sinks

HEADER = (
    "APP_NAME,RESTAURANT_ID,CREATION_TIME_UTC,ORDER_ID,USER_ID,PRINTED_CARD_NUMBER,IS_LOYALTY,"
    "CURRENCY,LINEITEM_ID,ITEM_CATEGORY,ITEM_NAME,ITEM_PRICE,ITEM_QUANTITY\n"
)


def write_items(tmp_path):
    path = tmp_path / "items.csv"
    path.write_text(
        HEADER
        + 'web,R1,2024-01-01T10:00:00.000Z,A,u1,00123,true,USD,L1,food,"1/4 Plate,\nWhite Meat",10.50,2\n'
        + 'web,R1,2024-01-01T10:00:00.000Z,A,,,false,USD,L2,food,"a ""big"" one",3,1\n'
        + "web,R1,2024-01-01T10:00:00.000Z,A,u1,,false,USD,,,,x,y\n"
    )
    return str(path)


def test_csv_with_line_breaks_and_quotes(spark, tmp_path):
    path = write_items(tmp_path)
    rows = files.read_csv(spark, path, "order_items").orderBy("LINEITEM_ID").collect()
    assert len(rows) == 2
    assert rows[0].ITEM_NAME == "1/4 Plate,\nWhite Meat" and rows[1].ITEM_NAME == 'a "big" one'
    assert rows[0].PRINTED_CARD_NUMBER == "00123" and rows[0].ITEM_PRICE == D("10.50")
    assert rows[1].USER_ID is None
    (bad,) = files.unparsed(files.read_csv_text(spark, path, "order_items"), "order_items").collect()
    assert bad.REJECT_REASON == "ITEM_PRICE is not decimal(10,2), ITEM_QUANTITY is not int"


OPTION_HEADER = "ORDER_ID,LINEITEM_ID,OPTION_GROUP_NAME,OPTION_NAME,OPTION_PRICE,OPTION_QUANTITY"


def one_task(spark, path):
    """The options of a file as one task reads them."""
    return spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(path)


def told(rows):
    return sorted(repr(tuple(r)) for r in rows.collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_are_found_wherever_a_block_begins(spark, settings, tmp_path, end):
    """Line breaks, quotes, separators and headers inside values, and blocks that begin at every byte of them."""
    odd = ['a "b" c', "two\nlines", "\n\n", "x\r\ny", ", , ,", '"', "", "é 中\n🙂", OPTION_HEADER + "\n1,2,3,4,5,6", '\n"\n""', "plain"]
    lines, want = [OPTION_HEADER], []
    for i, name in enumerate(odd * 3):
        want.append(repr((f"O{i}", f"L{i}", "g", name or None, f"{i}.50", "1")))
        value = '"' + name.replace('"', '""') + '"' if name != "plain" else name
        lines.append(f"O{i},L{i},g,{value},{i}.50,1")
    path = tmp_path / "options.csv"
    path.write_bytes((end.join(lines) + end).encode())
    for size in (29, 64, 997, 100_000):
        settings(spark__sql__files__maxPartitionBytes=str(size), spark__sql__files__openCostInBytes="0", spark__sql__shuffle__partitions="2")
        assert told(files.read_csv_text(spark, str(path), "order_item_options")) == sorted(want), size


def test_large_file_is_read_by_several_tasks(spark, settings, tmp_path):
    path = tmp_path / "options.csv"
    with open(path, "w") as out:
        out.write(OPTION_HEADER + "\n")
        for i in range(30_000):
            note = f'"line {i}\nand ""more"" {"x" * (i % 90)}"' if i % 3 else f"plain {i}"
            out.write(f"O{i},L{i},g,{note},{i % 50}.25,1\n")
    settings(spark__sql__files__maxPartitionBytes="150000")
    rows = files.read_csv_text(spark, str(path), "order_item_options")
    want = one_task(spark, str(path))
    assert want.rdd.getNumPartitions() == 1
    assert files.records(spark, str(path)).select("file").distinct().count() == 1
    blocks = spark.read.text(str(path)).select("_metadata.file_block_start").distinct().count()
    assert blocks >= 8
    assert rows.count() == 30_000 and rows.exceptAll(want).isEmpty() and want.exceptAll(rows).isEmpty()


def test_files_of_one_read_share_one_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text(OPTION_HEADER + "\nO1,L1,g,x,1,1\n")
    (tmp_path / "b.csv").write_text(OPTION_HEADER.replace("ORDER_ID,LINEITEM_ID", "LINEITEM_ID,ORDER_ID") + "\nL2,O2,g,x,1,1\n")
    with pytest.raises(Exception, match="has another header"):
        files.read_csv_text(spark, str(tmp_path), "order_item_options").collect()


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "calendar.csv"
    path.write_text(
        "date_key,year,month,week,day_of_week,is_weekend,is_holiday,holiday_name,note\n"
        "01-01-2024,2024,1,1,Mon,false,true,New Year,x\n"
    )
    (row,) = files.read_csv(spark, str(path), "date_dim").collect()
    assert (row.is_weekend, row.is_holiday, row.year) == ("false", "true", 2024) and "note" not in row.asDict()
    path = tmp_path / "options.csv"
    path.write_text(
        "LINEITEM_ID,ORDER_ID,OPTION_GROUP_NAME,OPTION_NAME,OPTION_QUANTITY,OPTION_PRICE\nL1,A,g,x,2,9.50\nL2,A,g,y,1,$9.50\n"
    )
    (row,) = files.read_csv(spark, str(path), "order_item_options").collect()
    assert (row.ORDER_ID, row.LINEITEM_ID, row.OPTION_PRICE, row.OPTION_QUANTITY) == ("A", "L1", D("9.50"), 2)
    text = files.read_csv_text(spark, str(path), "order_item_options")
    (bad,) = files.unparsed(text, "order_item_options").collect()
    assert (bad.LINEITEM_ID, bad.REJECT_REASON) == ("L2", "OPTION_PRICE is not decimal(10,2)")
    path.write_text("LINEITEM_ID,ORDER_ID\nL1,A\n")
    with pytest.raises(ValueError, match="OPTION_PRICE"):
        files.read_csv(spark, str(path), "order_item_options")


def test_text_is_cast_and_what_does_not_fit_is_null(spark, tmp_path):
    text = files.read_csv_text(spark, write_items(tmp_path), "order_items")
    assert set(dict(text.dtypes).values()) == {"string"}
    typed = enrich.typed_items(text)
    assert dict(typed.dtypes)["ITEM_PRICE"] == "decimal(10,2)"
    rows = typed.orderBy(F.asc_nulls_last("LINEITEM_ID")).collect()
    assert (rows[0].ITEM_PRICE, rows[0].ITEM_QUANTITY) == (D("10.50"), 2)
    assert (rows[2].ITEM_PRICE, rows[2].ITEM_QUANTITY) == (None, None)
    guessed = files.read_csv_inferred(spark, write_items(tmp_path))
    assert dict(guessed.dtypes)["PRINTED_CARD_NUMBER"] == "int"


def test_rewriting_a_partition_leaves_the_others(spark, tmp_path):
    schema = "ORDER_ID string, LINEITEM_ID string, LINE_REVENUE decimal(32,2), year int, month int, day int"
    first = spark.createDataFrame([("A", "L1", D(5), 2024, 1, 1)], schema)
    other = spark.createDataFrame([("B", "L2", D(7), 2024, 1, 2)], schema)
    path = str(tmp_path / "t")
    for frame in (first, first, other):
        sinks.replace_partitions(frame, path)
    assert sorted(r.ORDER_ID for r in spark.read.parquet(path).collect()) == ["A", "B"]
    by_date = str(tmp_path / "by_date")
    dated = first.withColumn("ORDER_DATE", F.lit(dt.date(2024, 1, 1)))
    sinks.replace_partitions(dated, by_date, ("ORDER_DATE",))
    assert spark.read.parquet(by_date).first().ORDER_DATE == dt.date(2024, 1, 1)
    flat = str(tmp_path / "flat")
    for frame in (first, other):
        sinks.replace_table(frame, flat)
    assert [r.ORDER_ID for r in files.read_table(spark, str(tmp_path), "flat").collect()] == ["B"]


def test_overwrite_mode_is_not_left_on_the_session(spark, tmp_path):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    frame = spark.range(3).withColumn("k", F.col("id") % 2)
    sinks.replace_partitions(frame, str(tmp_path / "p"), ("k",))
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_raw_day(spark, tmp_path):
    root = str(tmp_path)
    sinks.write_raw_day(items(spark, [("L1", "A", "u", None, 1, 1)]), root, "order_items", "2024-01-01")
    sinks.write_raw_day(items(spark, [("L2", "B", "u", None, 2, 1)]), root, "order_items", "2024-01-02")
    frame = files.read_raw_day(spark, root, "order_items", "2024-01-02")
    assert [(r.LINEITEM_ID, r.load_date) for r in frame.collect()] == [("L2", dt.date(2024, 1, 2))]
    scan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_date" in scan


def test_time_slices_cover_the_range_once():
    lo, hi = as_timestamp("2024-01-01"), as_timestamp("2024-01-02T00:00:00.000007")
    slices = jdbc.time_slices(lo, hi, 7)
    assert slices[0].lo == lo and slices[-1].hi == hi and len(slices) == 7
    assert all(a.hi == b.lo for a, b in zip(slices, slices[1:]))
    tiny = jdbc.time_slices(lo, lo + dt.timedelta(microseconds=2), 16)
    assert len(tiny) <= 3 and tiny[-1].hi == lo + dt.timedelta(microseconds=2)


def test_database_predicates_select_what_the_operator_selects(spark):
    """The conditions are SQL any database runs; Spark itself evaluates them here."""
    own = items(
        spark,
        [
            ("L1", "A", "u", "2024-01-01T00:00:00", 1, 1),
            ("L1", "A", "u", "2024-01-03T00:00:00", 1, 1),
            ("L2", "A", "u", "2024-01-02T00:00:00.5", 1, 1),
            ("L3", "B", "u", "2024-01-05T00:00:00", 1, 1),
            ("L4", "B", "u", "2024-01-09T00:00:00", 1, 1),
            ("L5", "B", "u", None, 1, 1),
            (None, "B", "u", "2024-01-03T00:00:00", 1, 1),
        ],
    )
    lines = [("A", "L1"), ("A", "L1"), ("A", "L2"), ("B", "L2"), ("B", "L3"), ("B", "L4"), ("B", "L5"), ("B", None)]
    opts = options(spark, [(o, line, f"n{i}", 1, 1) for i, (o, line) in enumerate(lines)])
    tables = {"order_items": own, "order_item_options": opts}
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)
    hi = "2024-01-05T00:00:00"
    for lo in (FLOOR_WATERMARK, "2024-01-01T00:00:00", "2024-01-02T00:00:00.500000"):
        slices = jdbc.time_slices(as_timestamp(lo), as_timestamp(hi), 5)
        for name in tables:
            want = incremental.select_batch(name, tables.get, lo, hi)
            parts = [
                spark.sql(f"SELECT * FROM {name} SRC WHERE {p}").collect()
                for p in jdbc.slice_predicates(name, slices)
            ]
            got = [row for part in parts for row in part]
            key = [*LINE_KEY, "OPTION_NAME" if name != "order_items" else "CREATION_TIME_UTC"]
            rows = lambda frame: sorted(repr([r[c] for c in key]) for r in frame)
            assert rows(got) == rows(want.collect())
    assert jdbc.slice_predicates("date_dim", slices) is None


# stands in for the database's own hash
SPARK_HASH = "pmod(xxhash64({key}), {parts})"


def skewed_tables(spark, n=6000):
    """Half of the lines in one second, a third of all in one instant of it, the rest over two years."""
    i = F.col("id")
    start = F.lit("2024-01-01").cast("timestamp")
    offset = F.when(i % 3 == 0, 5 * 10**6).when(i % 6 == 1, 5 * 10**6 + i * 100 % 10**6).otherwise(i * 10**10 % (63 * 10**12))
    lines = spark.range(0, n, 1, 4).select(
        F.timestamp_micros(F.unix_micros(start) + offset).alias("CREATION_TIME_UTC"),
        F.concat(F.lit("O"), (i / 2).cast("int")).alias("ORDER_ID"),
        F.when(i % 500 > 0, F.concat(F.lit("L"), i)).alias("LINEITEM_ID"),
    )
    options = lines.withColumn("OPTION_NAME", F.explode(F.array(F.lit("a"), F.lit("b"))))
    return {"order_items": lines, "order_item_options": options}


def test_slices_are_even_however_time_is_skewed(spark):
    tables = skewed_tables(spark)
    for name, frame in tables.items():
        frame.cache().createOrReplaceTempView(name)
    lo, hi = as_timestamp("2023-06-01"), as_timestamp("2027-01-01")
    asked = []

    def count(slices):
        asked.append(len(slices))
        conditions = jdbc.slice_predicates("order_items", slices, "order_items", SPARK_HASH)
        sums = ", ".join(f"SUM(CASE WHEN {c} THEN 1 ELSE 0 END)" for c in conditions)
        return [n or 0 for n in spark.sql(f"SELECT {sums} FROM order_items").first()]

    slices = jdbc.depth_slices(count, lo, hi, 8)
    assert len(asked) < 15 and slices[0].lo == lo and slices[-1].hi == hi
    for name in tables:
        predicates = jdbc.slice_predicates(name, slices, key_hash=SPARK_HASH)
        counts = [spark.sql(f"SELECT count(*) FROM {name} SRC WHERE {p}").first()[0] for p in predicates]
        loaded = incremental.select_batch(name, tables.get, lo, hi).count()
        # every row in exactly one slice, no slice over twice the mean
        assert sum(counts) == loaded > 0
        assert max(counts) <= 2 * loaded / len(slices), name
    # without a hash an instant stays whole
    assert all(s.parts == 1 for s in jdbc.depth_slices(count, lo, hi, 8, by_hash=False))


def test_slices_of_nothing(spark):
    lo, hi = as_timestamp("2024-01-01"), as_timestamp("2024-01-02")
    assert jdbc.depth_slices(lambda slices: [0] * len(slices), lo, hi, 8) == [jdbc.Slice(lo, hi)]
