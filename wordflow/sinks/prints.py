"""Rows printed for a look at them during development."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import DataStreamWriter


def _print_row(row: Row) -> None:
    print(*row, file=sys.stderr)


def print_elements(df: DataFrame) -> None:
    """Every row of a batch frame, to the standard error of the task that holds it."""
    df.foreach(_print_row)


def print_stream(df: DataFrame, mode: str = "append") -> DataStreamWriter:
    """A writer, ready to start, that prints every row of a stream the same way."""
    return df.writeStream.outputMode(mode).foreach(_print_row)
