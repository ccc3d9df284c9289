"""Lines of text files and lines from memory."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PINNED = "spark.sql.files.minPartitionNum"
# Bits of monotonically_increasing_id that count within a task.
SPLIT_BITS = 33

# Lines that a paced replay leaves out.
SKIPPED_LINES = (" *", "")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line`` per line of the UTF-8 files under ``path``; large files are split."""
    return spark.read.text(path).select(F.col("value").alias("line"))


def numbered_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line`` and ``line_no``, which rises along each file, with gaps.

    Files are cut into tasks by a rule that looks at the number of cores, unless
    the session pins it, as ``build_session`` does. Executors may come and go
    between two scans of one query and the numbers must not change.
    """
    if spark.conf.get(PINNED, None) is None:
        raise ValueError(f"set {PINNED}, so that two scans give a line the same number")
    return text_lines(spark, path).withColumn("line_no", F.monotonically_increasing_id())


def placed_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line`` and ``place``: 0, 1, 2 … through the files, without moving a line.

    A line's number says its split and its place in the split. Lines are counted
    per split; sums over the splits before, one row per split, are joined back.
    """
    lines = numbered_text_lines(spark, path).select(
        "line",
        F.shiftright("line_no", SPLIT_BITS).alias("split"),
        F.col("line_no").bitwiseAND((1 << SPLIT_BITS) - 1).alias("in_split"),
    )
    counts = lines.groupBy("split").agg(F.count("*").alias("n"))
    before = Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("split", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return lines.join(starts, "split").select("line", (F.col("start") + F.col("in_split")).alias("place"))


def stream_text_lines(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """``line`` per line of text files as they arrive under ``path``."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path).select(F.col("value").alias("line"))


def lines_from(spark: SparkSession, lines: Iterable[str]) -> DataFrame:
    """``line`` and its place ``line_no`` for a few lines from memory."""
    return spark.createDataFrame(list(enumerate(lines)), "line_no bigint, line string").select(
        "line", "line_no"
    )


def without_skipped(lines: DataFrame, line: str = "line") -> DataFrame:
    """Lines without empty ones and those that are a blank and a star only."""
    return lines.filter(~F.col(line).isin(*SKIPPED_LINES))
