"""Records of Kafka topics. Needs Spark's Kafka package on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What the connector gives, as documented.
KAFKA_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)


def text_records(raw: DataFrame) -> DataFrame:
    """Keys and values as text, the broker's timestamp as event time ``ts``."""
    places = [name for name in ("partition", "offset") if name in raw.columns]
    return raw.select(
        raw["key"].cast("string").alias("key"),
        raw["value"].cast("string").alias("value"),
        raw["timestamp"].alias("ts"),
        *places,
    )


def kafka_records(
    spark: SparkSession,
    servers: str,
    topic: str,
    stream: bool = True,
    starting: str | None = None,
    offsets_per_trigger: int | None = None,
) -> DataFrame:
    """``key, value, ts, partition, offset`` of a topic, as a stream or as it is now."""
    reader = spark.readStream if stream else spark.read
    reader = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
    )
    if starting:
        reader = reader.option("startingOffsets", starting)
    if offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_trigger)
    return text_records(reader.load())
