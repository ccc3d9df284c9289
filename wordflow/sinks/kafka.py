"""Records to Kafka topics. Needs Spark's Kafka package on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from wordflow.operators.records import to_records
from wordflow.sinks.outbox import DELIVERY, STAGED_AT

# Clocks of the driver and the brokers may differ by so many milliseconds.
CLOCKS = 3_600_000


def _with_headers(records: DataFrame) -> DataFrame:
    """A record's id as a header."""
    header = F.struct(F.lit(DELIVERY).alias("key"), F.col(DELIVERY).cast("binary").alias("value"))
    return records.select("key", "value", F.array(header).alias("headers"))


def write_records(
    df: DataFrame, servers: str, topic: str, key: str = "key", value: str = "value", with_ids: bool = False
) -> None:
    """A batch frame's key and value columns, encoded, to a topic; ids of an outbox as headers if asked."""
    records = _with_headers(to_records(df, key, value, DELIVERY)) if with_ids else to_records(df, key, value)
    (
        records.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def delivered_ids(messages: DataFrame) -> DataFrame:
    """The ids in the headers of a topic's messages."""
    own = F.filter("headers", lambda header: header["key"] == DELIVERY)
    return messages.select(F.get(own, 0)["value"].cast("string").alias(DELIVERY)).dropna()


def arrived_in_topic(records: DataFrame, servers: str, topic: str) -> DataFrame:
    """The ids that a topic holds since ``records``, rows of an outbox, were put there."""
    since = records.agg(F.min(STAGED_AT)).first()[0] or 0
    return delivered_ids(
        records.sparkSession.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("includeHeaders", "true")
        .option("startingTimestamp", max(0, since - CLOCKS))
        .option("startingOffsetsByTimestampStrategy", "latest")
        .load()
    )


def record_stream(
    df: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    key: str = "key",
    value: str = "value",
    mode: str = "append",
) -> DataStreamWriter:
    """A writer, ready to start, for a streaming frame's records."""
    return (
        to_records(df, key, value)
        .writeStream.format("kafka")
        .outputMode(mode)
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
