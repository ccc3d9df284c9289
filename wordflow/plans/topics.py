"""The streaming jobs from one Kafka topic to another.

Each gives a writer that is ready to start; ``wordflow.streaming.runs.start``
starts it with exact lateness. Input keys count as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from wordflow.functions.mergeable import AVERAGE_LENGTH, LONGEST_WORD
from wordflow.operators.records import keyed_lines, with_key
from wordflow.operators.tokens import words
from wordflow.sinks.kafka import arrived_in_topic, record_stream, write_records
from wordflow.sinks.outbox import Outbox
from wordflow.sources.kafka import kafka_records
from wordflow.streaming.running import combine_so_far
from wordflow.streaming.windows import top_k_stream


def top_k_words_topic(
    spark: SparkSession,
    servers: str,
    input_topic: str,
    output_topic: str,
    checkpoint: str,
    size: str = "10 seconds",
    k: int = 3,
    lateness: str = "0 seconds",
) -> DataStreamWriter:
    """Key: word, value: its count as a long. Window bounds are not written.

    Every record arrives once, also if the query is killed between a send and its
    commit: see ``Outbox``. Ids travel as headers.
    """
    lines = keyed_lines(kafka_records(spark, servers, input_topic))

    def send(records: DataFrame) -> None:
        write_records(records, servers, output_topic, key="word", value="n", with_ids=True)

    def arrived(records: DataFrame) -> DataFrame:
        return arrived_in_topic(records, servers, output_topic)

    name, folder = f"{input_topic} to {output_topic}", f"{checkpoint}/delivery"
    outbox = Outbox(spark, name, folder, ["window_start", "word"], send, arrived)
    return top_k_stream(lines, size, k, outbox, checkpoint, lateness=lateness)


def longest_word_topic(
    spark: SparkSession, servers: str, input_topic: str, output_topic: str, checkpoint: str
) -> DataStreamWriter:
    """Key: empty, value: the longest word so far, after each micro-batch."""
    lines = keyed_lines(kafka_records(spark, servers, input_topic))
    found = words(lines.withWatermark("ts", "0 seconds"))
    order = ["ts", "partition", "offset", "pos"]
    so_far = combine_so_far(found, LONGEST_WORD, order=order, repeat_last=True)
    return record_stream(
        with_key(so_far), servers, output_topic, checkpoint, value="word", mode="update"
    )


def average_word_length_topic(
    spark: SparkSession, servers: str, input_topic: str, output_topic: str, checkpoint: str
) -> DataStreamWriter:
    """Key: empty, value: the average word length so far as a double."""
    lines = keyed_lines(kafka_records(spark, servers, input_topic))
    so_far = combine_so_far(words(lines, pos=None), AVERAGE_LENGTH)
    return record_stream(
        with_key(so_far), servers, output_topic, checkpoint, value="avg_len", mode="update"
    )
