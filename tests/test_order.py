import random

import pytest
from conftest import plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from wordflow.operators.order import order_number, split_points, with_range


def shares(df, order, points):
    placed = with_range(df, order, points, "r")
    return {row.r: row["count"] for row in placed.groupBy("r").count().collect()}


def test_even_keys_give_even_ranges(spark):
    exact = spark.range(500)
    points = split_points(exact, ["id"], 10)
    assert points == [(50 * i - 1,) for i in range(1, 10)]
    sampled = spark.range(50_000)
    points = split_points(sampled, ["id"], 10)
    assert 8 <= len(points) <= 12
    assert max(shares(sampled, ["id"], points).values()) < 10_000


def test_a_hot_first_key_is_cut_by_the_second(spark):
    df = spark.range(12_000).selectExpr("if(id % 3 = 0, 77L, id) as a", "id as b")
    points = split_points(df, ["a", "b"], 12)
    assert max(shares(df, ["a", "b"], points).values()) < 2_000


def test_two_hot_levels(spark):
    df = spark.range(8_000).selectExpr("1 as a", "if(id % 2 = 0, 5L, id) as b", "id as c")
    points = split_points(df, ["a", "b", "c"], 8)
    assert max(shares(df, ["a", "b", "c"], points).values()) < 2_000


def test_no_rows_and_one_range(spark):
    assert split_points(spark.range(0), ["id"], 8) == []
    assert split_points(spark.range(100), ["id"], 1) == []


def test_null_keys_come_first(spark):
    df = spark.createDataFrame([(None,), (1,), (2,), (3,), (4,)], "id bigint")
    placed = with_range(df, ["id"], [(1,), (3,)], "r")
    assert [row.r for row in placed.orderBy("id").collect()] == [0, 0, 1, 1, 2]


def test_times_without_zone_ignore_the_session_zone(spark):
    texts = ["1969-12-31 23:59:59.999999", "2024-03-10 01:59:59.5", "2024-03-10 02:30:00",
             "2024-03-10 03:00:00.000001", "2024-11-03 01:30:00"]
    df = spark.createDataFrame([(text,) for text in texts], "t string")
    df = df.select(F.col("t").cast("timestamp_ntz").alias("t"))
    in_utc = [row.n for row in df.select(F.unix_micros(F.col("t").cast("timestamp")).alias("n")).collect()]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = [row.n for row in df.select(order_number(df, "t").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == in_utc


def test_text_keys_are_refused(spark):
    with pytest.raises(TypeError, match="neither integer nor timestamp"):
        split_points(spark.createDataFrame([("a",)], "name string"), ["name"], 2)


def test_null_points_come_first(spark):
    df = spark.createDataFrame([(None, 1), (None, 5), (0, 0), (2, None), (2, 1)], "a bigint, b bigint")
    points = [(None, 1), (None, 3), (1, 1), (2, None)]
    placed = with_range(df, ["a", "b"], points, "r")
    assert [row.r for row in placed.orderBy("a", "b").collect()] == [0, 2, 2, 3, 4]


def test_search_stays_in_generated_code(spark):
    plan = plan_of(with_range(spark.range(10), ["id"], [(3,), (5,), (7,)], "r"))
    assert "from_json" not in plan and "lambda" not in plan
    assert all(line.lstrip(" +-:").startswith("*(1)") for line in plan.strip().splitlines())


KEYS = st.lists(st.tuples(st.integers(-50, 50), st.integers(-5, 5)), min_size=1, max_size=60)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(KEYS, st.integers(1, 9))
def test_ranges_follow_the_order(spark, keys, ranges):
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame(keys, "a bigint, b bigint")
    points = split_points(df, ["a", "b"], ranges)
    assert points == sorted(set(points))
    assert len(points) <= max(1, ranges)
    placed = with_range(df, ["a", "b"], points, "r")
    for row in placed.collect():
        assert row.r == sum(point < (row.a, row.b) for point in points)
