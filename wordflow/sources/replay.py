"""Stored files played back as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from wordflow.session import file_system
from wordflow.sources.text import stream_text_lines, without_skipped

# A name that no table has.
PART = "feed_part"


def replay_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "parquet",
    pattern: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """The files under ``path``, oldest first, ``files_per_trigger`` in a micro-batch.

    Start the query with ``trigger(availableNow=True)`` to stop at the end.
    """
    reader = spark.readStream.format(file_format).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def replay_table(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """A stored parquet table as a stream, whether it is one file or a folder of files.

    A stream cannot open a single file by its path, so its folder is opened with
    the file's name as a filter. Files come oldest first: if their times overlap,
    the lateness must cover it, or rows are dropped.
    """
    schema = spark.read.parquet(path).schema
    files, place = file_system(spark, path)
    if files.getFileStatus(place).isDirectory():
        return replay_stream(spark, path, schema, files_per_trigger=files_per_trigger)
    folder, _, name = path.rstrip("/").rpartition("/")
    return replay_stream(spark, folder, schema, pattern=name, files_per_trigger=files_per_trigger)


def staged_parts(rows: DataFrame, folder: str, part: Column) -> list[str]:
    """Writes ``rows`` once, a folder per value of ``part``, and names the folders in its order.

    ``part`` is a whole number. ``put`` hands the folders to a stream one by one, so
    the rows are read once, however many parts there are.
    """
    spark = rows.sparkSession
    rows.withColumn(PART, part.cast("bigint")).write.partitionBy(PART).parquet(folder)
    files, place = file_system(spark, folder)
    names = [status.getPath().getName() for status in files.listStatus(place)]
    found = sorted(int(name.partition("=")[2]) for name in names if name.startswith(f"{PART}="))
    return [f"{folder}/{PART}={number}" for number in found]


def put(spark: SparkSession, part: str, feed: str) -> None:
    """Moves a staged folder under ``feed``, all its files at once; nothing if it was moved before."""
    files, place = file_system(spark, part)
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{feed}/part-{part.rpartition('=')[2]}")
    if files.exists(place) and not files.rename(place, target):
        raise OSError(f"cannot move {part} to {target}")


def fed_stream(spark: SparkSession, feed: str, schema: T.StructType) -> DataFrame:
    """A stream of the folders that will be ``put`` under ``feed``."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{feed}/start")
    return replay_stream(spark, f"{feed}/*", schema)


def paced_lines(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Lines of text files, a few files at a time, without the skipped lines.

    The pace comes from the query's trigger, ``trigger(processingTime=…)``.
    """
    return without_skipped(stream_text_lines(spark, path, files_per_trigger))
