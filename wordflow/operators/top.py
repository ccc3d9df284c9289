"""The top k over all windows so far, after each window."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordflow.functions.top import TopEntries
from wordflow.operators.counts import WINDOW, top_k_per_window
from wordflow.operators.order import order_number, split_points, with_range

# A name that no table has.
RANGE = "__order_range"
# The range of entries that come before all windows.
BEFORE_ALL = -1
#: Entries: a word's count in the window that begins at ``found_at``, in microseconds.
ENTRY = ["word", "n", "found_at"]
MOVED = f"{RANGE} int, at bigint, until bigint, word string, n bigint, found_at bigint"
RUNNING = "at bigint, until bigint, rank int, word string, n bigint, found_at bigint"


def best_entries(entries: DataFrame, k: int, *group: str) -> DataFrame:
    """The ``k`` best entries of each group. Tasks keep ``k`` rows of a group before the shuffle."""
    order = Window.partitionBy(*(group or [F.lit(0)])).orderBy(F.col("n").desc(), "word", "found_at")
    return entries.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("rank")


def entries_of(counts: DataFrame, k: int, element: str = "word", n: str = "n") -> DataFrame:
    """``at, until`` and the entries of finished windows: of each one the ``k`` that can matter."""
    start, end = (order_number(counts, name) for name in WINDOW)
    best = top_k_per_window(counts, k, element, n)
    return best.select(
        start.alias("at"),
        end.alias("until"),
        F.col(element).alias("word"),
        F.col(n).cast("bigint").alias("n"),
        start.alias("found_at"),
    )


def _starts(k: int):
    """Per range what was best before it. Rows come by range; one of each marks its beginning."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top, now = TopEntries(k), None
        for frame in frames:
            rows = []
            for number, word, n, found_at in frame[[RANGE, *ENTRY]].itertuples(index=False):
                if number != now:
                    rows += [(number, w, -m, at) for m, w, at in top.entries] if number > BEFORE_ALL else []
                    now = number
                if word is not None:
                    top.add((-int(n), word, int(found_at)))
            yield pd.DataFrame(rows, columns=[RANGE, *ENTRY])

    return run


def _running(k: int):
    """The accumulator after each window of a range. A range's start entries come first, without a window."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top, now, window = TopEntries(k), None, None

        def result() -> list[tuple]:
            return [(*window, i + 1, word, -n, at) for i, (n, word, at) in enumerate(top.entries)]

        for frame in frames:
            rows: list[tuple] = []
            for number, at, until, word, n, found_at in frame.itertuples(index=False):
                here = None if pd.isna(at) else (int(at), int(until))
                if window is not None and (number, here) != (now, window):
                    rows += result()
                if number != now:
                    top = TopEntries(k)
                now, window = number, here
                top.add((-int(n), word, int(found_at)))
            if rows:
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in RUNNING.split(", ")])
        if window is not None:
            yield pd.DataFrame(result(), columns=[c.split()[0] for c in RUNNING.split(", ")])

    return run


def running_top_k(
    counts: DataFrame,
    k: int,
    element: str = "word",
    n: str = "n",
    start: DataFrame | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """After each window of finished ``counts`` the ``k`` largest counts of all windows up to it.

    Gives ``window_start, window_end, rank, word, n, found_at``; ``found_at`` is the
    start of the window that the count is from. Equal counts go by word, then by
    window. ``start`` holds entries (``ENTRY``) that come before all windows. A null
    word is no entry.

    A prefix scan over accumulators of ``k`` entries: windows are cut into ranges
    of time, each range is reduced to its ``k`` best, these are merged range by
    range, and every range starts from what lies before it. Only the one step that
    merges the ranges, ``k`` rows of each, is a single task.
    """
    session = counts.sparkSession
    tasks = ranges or int(session.conf.get("spark.sql.shuffle.partitions"))
    found = entries_of(counts.filter(F.col(element).isNotNull()), k, element, n)
    points = split_points(found, ["at"], tasks)
    placed = with_range(found, ["at"], points, RANGE).withColumn(RANGE, F.col(RANGE).cast("int"))
    totals = best_entries(placed, k, RANGE).select(RANGE, *ENTRY)
    if start is not None:
        totals = totals.unionByName(start.select(F.lit(BEFORE_ALL).alias(RANGE), *ENTRY))
    # A row without an entry opens each range, also one that has no windows.
    opened = session.range(len(points) + 1).select(
        F.col("id").cast("int").alias(RANGE), *[F.lit(None).cast(t).alias(c) for c, t in zip(ENTRY, ("string", "bigint", "bigint"))]
    )
    in_turn = totals.unionByName(opened).repartition(1).sortWithinPartitions(F.col(RANGE), F.col("word").asc_nulls_first())
    starts = in_turn.mapInPandas(_starts(k), f"{RANGE} int, word string, n bigint, found_at bigint")
    no_window = F.lit(None).cast("bigint")
    rows = placed.select(RANGE, "at", "until", *ENTRY).unionByName(
        starts.select(RANGE, no_window.alias("at"), no_window.alias("until"), *ENTRY)
    )
    moved = rows.repartitionById(len(points) + 1, F.col(RANGE)).sortWithinPartitions(
        F.col(RANGE), F.col("at").asc_nulls_first()
    )
    running = moved.mapInPandas(_running(k), RUNNING)
    kind = counts.schema["window_start"].dataType
    return running.select(
        _as_time("at", kind).alias("window_start"), _as_time("until", kind).alias("window_end"),
        "rank", F.col("word").alias(element), F.col("n").alias(n), _as_time("found_at", kind).alias("found_at"),
    )


def _as_time(micros: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(micros)
    # Without a zone: from the epoch on, by intervals that no zone changes.
    return F.expr(f"timestamp_ntz'1970-01-01' + make_dt_interval(0, 0, 0, {micros} / 1000000BD)")
