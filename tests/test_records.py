import struct
from datetime import datetime

from wordflow.operators.records import keyed_lines, to_records, value_lines, with_key
from wordflow.sources.kafka import KAFKA_SCHEMA, text_records

RECORDS = [("k", "v w"), (None, "v"), ("k", None), (None, None)]


def test_keyed_lines(spark):
    df = spark.createDataFrame(RECORDS, "key string, value string")
    assert [row.line for row in keyed_lines(df).collect()] == ["k v w", " v", "k ", " "]


def test_value_lines(spark):
    df = spark.createDataFrame(RECORDS, "key string, value string")
    assert [row.line for row in value_lines(df).collect()] == ["v w", "v", "", ""]


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(1, 7, "v")], "at int, key bigint, value string")
    assert [tuple(row) for row in keyed_lines(df).collect()] == [(1, "7 v")]


def test_long_values(spark):
    numbers = [0, 1, 255, 2**40, 2**63 - 1, -1, -(2**63)]
    df = spark.createDataFrame([(f"é{n}", n) for n in numbers], "word string, n bigint")
    rows = to_records(df, key="word", value="n").collect()
    assert [bytes(row.value) for row in rows] == [struct.pack(">q", n) for n in numbers]
    assert [bytes(row.key) for row in rows] == [f"é{n}".encode() for n in numbers]


def test_double_values(spark):
    numbers = [0.0, -0.0, 1.5, -2.25, 1e300, 5e-324, float("inf"), float("nan")]
    df = spark.createDataFrame([(n,) for n in numbers], "x double")
    rows = to_records(with_key(df), value="x").collect()
    assert [bytes(row.value) for row in rows] == [struct.pack(">d", n) for n in numbers]
    assert {bytes(row.key) for row in rows} == {b""}


def test_null_values(spark):
    df = spark.createDataFrame([(None, None, None)], "s string, n bigint, x double")
    for name in df.columns:
        assert to_records(with_key(df), value=name).first().value is None


def test_record_columns(spark):
    df = spark.createDataFrame([("w", 1, "start")], "word string, n bigint, window_start string")
    assert to_records(df, "word", "n").columns == ["key", "value"]


def test_text_of_kafka_rows(spark):
    at = datetime(2024, 1, 1)
    df = spark.createDataFrame([(None, bytearray(b"v"), "t", 0, 5, at, 0)], KAFKA_SCHEMA)
    assert text_records(df).first().asDict() == {
        "key": None, "value": "v", "ts": at, "partition": 0, "offset": 5,
    }
