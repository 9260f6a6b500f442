"""Tiles and ranks found by counting, against the single-partition windows they replace."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderlake.operators import ranking
from orderlake.operators.ranking import Order, rank_desc, tile


@pytest.fixture(params=[(4096, 2048), (3, 2)], ids=["wide", "narrow"])
def counting(request, monkeypatch):
    """Few buckets and few rows looked at, so that small tables take many rounds."""
    monkeypatch.setattr(ranking, "BUCKETS", request.param[0])
    monkeypatch.setattr(ranking, "FEW", request.param[1])


def base(spark, n, value):
    return spark.range(0, n, 1, 6).select(
        F.concat(F.lit("U"), "id").alias("u"), F.expr(value).cast("decimal(12,2)").alias("v")
    )


@pytest.mark.parametrize("n", [0, 3, 7, 1503])
@pytest.mark.parametrize(
    "value",
    ["CASE WHEN id % 10 > 0 THEN 5 ELSE id END", "CASE WHEN id % 3 > 0 THEN id * 7 % 101 END", "1"],
)
@pytest.mark.parametrize("descending", [False, True])
def test_tile_equals_ntile(spark, counting, n, value, descending):
    order = [F.desc_nulls_last("v") if descending else F.asc_nulls_first("v"), F.asc("u")]
    got = tile(base(spark, n, value), 5, Order("v", "u", descending), "t")
    want = base(spark, n, value).withColumn("t", F.ntile(5).over(Window.orderBy(*order)))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_several_orders_and_rows_left_out_are_tiled_at_once(spark, counting):
    number = F.substring("u", 2, 9).cast("bigint")
    df = base(spark, 900, "id * 13 % 50").withColumns({"w": -(number % 7), "in": number % 4 > 0})
    orders = [Order("v", "u"), Order("w", "u", descending=True, among="in")]
    one, two = ranking.tile_edges(df, 4, orders)
    got = df.withColumns({"a": ranking.tile_number(one, orders[0]), "b": ranking.tile_number(two, orders[1])})
    want = df.withColumn("a", F.ntile(4).over(Window.orderBy("v", "u")))
    assert got.drop("b").exceptAll(want).isEmpty()
    some = df.filter("in").withColumn("b", F.ntile(4).over(Window.orderBy(F.desc("w"), "u")))
    assert got.filter("in").drop("a").exceptAll(some).isEmpty()


def test_a_tie_is_cut_within_its_keys(spark, counting):
    # two thirds of the rows tie, and their keys share long prefixes
    df = spark.range(0, 6000, 1, 6).select(
        F.format_string("customer-%08d", "id").alias("u"), F.expr("IF(id % 3 > 0, 7, id)").cast("int").alias("v")
    )
    got = tile(df, 5, Order("v", "u"), "t")
    want = df.withColumn("t", F.ntile(5).over(Window.orderBy("v", "u")))
    assert got.exceptAll(want).isEmpty()


def test_rounds_bring_counts_and_not_rows(spark, monkeypatch):
    seen = []
    look, count = ranking._look, ranking._count
    monkeypatch.setattr(ranking, "_look", lambda rows, ranges: [*map(lambda f: seen.append(len(f[1][0])) or f, look(rows, ranges))])
    monkeypatch.setattr(ranking, "_count", lambda rows, ranges: [*map(lambda f: seen.append(len(f[1])) or f, count(rows, ranges))])
    df = spark.range(0, 300_000, 1, 8).select(F.col("id").cast("string").alias("u"), F.expr("IF(id % 3 = 0, 5, id * id)").alias("v"))
    (edges,) = ranking.tile_edges(df, 5, [Order("v", "u")])
    assert len(edges) == 4 and seen and max(seen) <= ranking.BUCKETS + 1 and len(seen) < 30


def test_unfit_values_are_refused(spark):
    with pytest.raises(TypeError, match="double"):
        tile(spark.range(3).selectExpr("string(id) AS u", "double(id) AS v"), 5, Order("v", "u"), "t")


@pytest.mark.parametrize("value", ["id % 13", "CASE WHEN id % 2 = 0 THEN id END", "1", "CASE WHEN id < 0 THEN 1 END"])
@pytest.mark.parametrize("n", [0, 500])
def test_rank_equals_rank(spark, counting, value, n):
    got = rank_desc(base(spark, n, value), "v", "u", "r")
    want = base(spark, n, value).withColumn("r", F.rank().over(Window.orderBy(F.desc_nulls_last("v"))))
    assert got.select("u", "v", "r").exceptAll(want).isEmpty() and got.count() == n
