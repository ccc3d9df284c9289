"""Starting queries with exact lateness, and running bounded input to its end."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from wordflow.sources.replay import put

# A query keeps the settings it was started with.
STREAM_SETTINGS = {
    # Late rows are judged by the watermark of the micro-batch before, not by
    # the one before that. Allows one stateful operator per query.
    "spark.sql.streaming.statefulOperator.allowMultiple": "false",
}

# Later than any event.
END_OF_TIME = "9999-01-01 00:00:00"


@contextmanager
def stream_settings(spark: SparkSession) -> Iterator[None]:
    """``STREAM_SETTINGS`` for queries that start inside the block."""
    before = {key: spark.conf.get(key, None) for key in STREAM_SETTINGS}
    for key, value in STREAM_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def start(spark: SparkSession, writer: DataStreamWriter) -> StreamingQuery:
    with stream_settings(spark):
        return writer.start()


def run_available(spark: SparkSession, writer: DataStreamWriter) -> None:
    """All input there is now, in as many micro-batches as the source makes of it."""
    start(spark, writer.trigger(availableNow=True)).awaitTermination()


def _closing_row(spark: SparkSession, schema: T.StructType, ts: str) -> DataFrame:
    def value(field: T.StructField):
        if field.name == ts:
            return F.lit(END_OF_TIME)
        # Empty text, not null: Spark drops null lines before it looks at the time.
        return F.lit("" if isinstance(field.dataType, T.StringType) else None)

    return spark.range(1).select(
        *[value(field).cast(field.dataType).alias(field.name) for field in schema]
    )


@contextmanager
def running(spark: SparkSession, writer: DataStreamWriter) -> Iterator[StreamingQuery]:
    """A query that runs inside the block. ``processAllAvailable`` waits until it has caught up."""
    query = start(spark, writer)
    try:
        yield query
    finally:
        query.stop()


def run_in_turn(spark: SparkSession, writer: DataStreamWriter, parts: Iterable[str], feed: str) -> None:
    """The staged ``parts`` put under ``feed`` one after the other, each a micro-batch of one query."""
    with running(spark, writer) as query:
        for part in parts:
            put(spark, part, feed)
            query.processAllAvailable()


def run_to_end(
    lines: DataFrame,
    folder: str,
    writer: Callable[[DataFrame], DataStreamWriter],
    ts: str = "ts",
    parts: Iterable[str] = (),
    feed: str | None = None,
) -> None:
    """Run over all available ``lines``, then let every open window close.

    ``parts``, if given, are staged folders that are put under ``feed``, where
    ``lines`` reads, one after the other: every part is a micro-batch of its own.

    Spark leaves the last windows open when a source ends. So the query reads a
    second source under ``folder`` too, empty at first; once the input is done a
    row without words and with a time after all others is put there. ``writer``
    must set a checkpoint location. After a failure the same call may be made
    again: the query resumes from its checkpoint, and parts are put once.
    """
    spark = lines.sparkSession
    spark.createDataFrame([], lines.schema).write.mode("ignore").parquet(folder)
    ending = spark.readStream.schema(lines.schema).parquet(folder)
    with running(spark, writer(lines.unionByName(ending))) as query:
        query.processAllAvailable()
        for part in parts:
            put(spark, part, feed)
            query.processAllAvailable()
        _closing_row(spark, lines.schema, ts).write.mode("append").parquet(folder)
        query.processAllAvailable()
