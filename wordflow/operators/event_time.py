"""Event times for rows that have an order but no time."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordflow.functions.mergeable import ELEMENT_COUNT
from wordflow.operators.running import running_combine


def assign_event_time(
    rows: DataFrame,
    order: Sequence[str],
    base: datetime,
    step_ms: int = 1,
    ts: str = "ts",
    ranges: int | None = None,
) -> DataFrame:
    """Row ``i`` in ``order``, counted from 0, gets the time ``base + i * step_ms``.

    ``base`` without a time zone is in the session's.
    """
    numbered = running_combine(rows, ELEMENT_COUNT, order, ranges=ranges)
    return numbered.select(*rows.columns, time_of(base, step_ms).alias(ts))


def time_of(base: datetime, step_ms: int) -> Column:
    """The time of a row by its number from 1 on, as ``ELEMENT_COUNT`` gives it."""
    start = F.unix_micros(F.lit(base.isoformat(sep=" ")).cast("timestamp"))
    offset = (F.col(ELEMENT_COUNT.result) - 1) * (step_ms * 1000)
    return F.timestamp_micros(start + offset)
