"""Values as of any day, and tiers over time, against plain versions."""

import datetime as dt
import random
from bisect import bisect_right
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from orderlake.operators import customers, history
from orderlake.operators.asof import last_known
from orderlake.plans.queries import MONTH_ENDS, Tables

START = dt.date(2023, 12, 1)


def date(n):
    return START + dt.timedelta(days=n)


@pytest.mark.parametrize("span_days", [1, 7, 90, 5000])
def test_last_known_equals_bisection(spark, span_days):
    rng = random.Random(span_days)
    history_rows = {(rng.choice(["a", "b", "busy", None]), rng.choice([None, *range(200)])): rng.choice([None, 1, 2, 3]) for _ in range(150)}
    points = [(i, rng.choice(["a", "b", "busy", "c", None]), rng.choice([None, *range(-20, 260)])) for i in range(400)]
    points += [(1000, "busy", 50)] * 50
    known = spark.createDataFrame([(k, d is not None and date(d) or None, v) for (k, d), v in history_rows.items()], "k string, since date, v int")
    asked = spark.createDataFrame([(i, k, d is not None and date(d) or None) for i, k, d in points], "id int, k string, at date").repartition(3)
    days = defaultdict(list)
    for (k, d), v in history_rows.items():
        if k is not None and d is not None:
            days[k].append((d, v))
    days = {k: sorted(v, key=lambda x: x[0]) for k, v in days.items()}

    def value(k, d):
        own = days.get(k, []) if d is not None else []
        place = bisect_right([x for x, _ in own], d) if own else 0
        return own[place - 1][1] if place else None

    got = last_known(asked, known, ["k"], "at", "since", ["v"], span_days)
    assert got.columns == ["id", "k", "at", "v"]
    want = sorted((i, str(k), str(d if d is None else date(d)), str(value(k, d))) for i, k, d in points)
    assert sorted((r.id, str(r.k), str(r["at"]), str(r.v)) for r in got.collect()) == want


def test_busy_customer_is_spread_over_tasks(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="40",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
    )
    # one customer has a third of all points, half of them on one day
    hot = F.col("id") % 3 == 0
    day = F.when(F.col("id") % 2 == 0, 17).otherwise(F.col("id") % 3650).cast("int")
    points = spark.range(0, 120_000, 1, 8).select(
        F.when(hot, "busy").otherwise(F.concat(F.lit("c"), "id")).alias("USER_ID"),
        F.date_add(F.lit(START), day).alias("AS_OF"),
        F.sha2(F.col("id").cast("string"), 256).alias("note"),
    )
    daily = spark.range(0, 3650, 1, 8).select(
        F.lit("busy").alias("USER_ID"), F.date_add(F.lit(START), F.col("id").cast("int")).alias("SNAPSHOT_DATE"), F.col("id").alias("RUNNING_LTV")
    )
    result = customers.value_at(daily, points).groupBy("USER_ID").agg(
        F.count_if(F.col("VALUE") == F.datediff("AS_OF", F.lit(START))).alias("right"), F.count("VALUE").alias("n"), F.max("note").alias("note")
    )
    row = result.filter("USER_ID = 'busy'").collect()[0]
    assert row.right == row.n == 40_000
    text = result._jdf.queryExecution().executedPlan().toString()
    result.collect()
    assert result.filter("n > 0").count() == 1
    whole = customers.value_at(daily, points).agg(F.max("note"), F.count("VALUE").alias("n"))
    assert whole.collect()[0].n == 40_000
    text = whole._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # windows are dealt by customer and stretch, or see one row per stretch
    assert "_span" in text


def rows(df):
    return sorted((r.USER_ID, r.CLV_TAG, str(r.VALID_FROM), str(r.VALID_TO)) for r in df.select("USER_ID", "CLV_TAG", "VALID_FROM", "VALID_TO").collect())


def test_runs_one_after_the_other_equal_all_at_once(spark):
    rng = random.Random(1)
    names = ["d0", "d1", "d2", "d3", "d4"]
    tags = spark.createDataFrame(
        [(f"u{i}", *[rng.choice([None, "High", "Low", "Med"]) for _ in names]) for i in range(60)], "USER_ID string, " + ", ".join(f"{n} string" for n in names)
    )
    runs = {name: date(10 * i) for i, name in enumerate(names)}
    open_ = spark.createDataFrame([], "USER_ID string, CLV_TAG string, VALID_FROM date")
    closed_rows = []
    for name, day in runs.items():
        now = tags.filter(F.col(name).isNotNull()).select("USER_ID", F.col(name).alias("CLV_TAG"))
        for _ in range(2):
            # a run repeated changes nothing
            closed, open_next = history.advance(open_, now, day)
            closed_rows += rows(closed)
            open_ = spark.createDataFrame(open_next.collect(), open_next.schema)
    told = closed_rows + rows(open_.withColumn("VALID_TO", F.lit(None).cast("date")))
    assert sorted(told) == rows(history.intervals(tags, runs))


def test_migration_from_the_history_equals_migration_from_values(spark, small_data):
    daily = customers.daily_spend(Tables(spark, small_data).silver)
    runs = {f"run_{i}": day for i, day in enumerate(MONTH_ENDS)}
    told = history.intervals(customers.tags_on(daily, runs), runs)
    moved = history.migration(told, MONTH_ENDS[0], MONTH_ENDS[2])
    want = customers.tier_migration(daily, MONTH_ENDS[0], MONTH_ENDS[2])
    assert sorted(map(tuple, moved.collect())) == sorted(map(tuple, want.collect()))
    # between two runs the tiers of the earlier one hold
    between = history.migration(told, "2000-05-15", "2000-10-01")
    assert sorted(map(tuple, between.collect())) == sorted(map(tuple, want.collect()))
