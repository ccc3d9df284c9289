"""Word counts of windows that fire when the watermark passes them, and again for late rows.

Every firing is a pane: the first one holds what came in time, each later one the
late rows of one micro-batch alone, since a fired pane is discarded. Rows later
than the allowed lateness are dropped, as the window is gone by then.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wordflow.operators.tokens import words

ON_TIME, LATE = "on_time", "late"
PANES = "end_ms bigint, word string, pane int, timing string, is_last boolean, n bigint"
PANE_COLUMNS = [c.split()[0] for c in PANES.split(", ")]
# Whether the first pane fired, and per word its panes so far and the count that waits for the first.
STATE = "fired boolean, words string"


def milliseconds(spark: SparkSession, interval: str) -> int:
    """A length of time such as ``6 hours``."""
    return spark.sql(f"select unix_millis(timestamp_millis(0) + interval {interval})").first()[0]


def _fire(size: int, lateness: int) -> Callable[..., Iterator[pd.DataFrame]]:
    delay = size + lateness

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        end = int(key[0])
        # The query's watermark stays back by ``delay``, so that Spark drops no row of a window
        # that is still there. The event time that was reached is so much further on.
        mark = state.getCurrentWatermarkMs()
        reached = mark + delay
        gone = mark > 0 and end <= reached - lateness
        fired, text = state.get if state.exists else (False, "{}")
        words: dict[str, list[int]] = json.loads(text)
        rows: list[tuple] = []

        def fire(found: dict[str, int], timing: str) -> None:
            for word, n in found.items():
                panes = words.setdefault(word, [0, 0])
                rows.append((end, word, panes[0], timing, gone and timing == ON_TIME, n))
                panes[:] = panes[0] + 1, 0

        waiting = {word: n for word, (_, n) in words.items() if n}
        if state.hasTimedOut:
            fire(waiting, ON_TIME)
            fired = True
        elif gone:
            return
        else:
            found: Counter[str] = Counter()
            for frame in frames:
                found.update(frame["word"])
            if mark > 0 and end <= reached:
                fire(waiting, ON_TIME)
                fire(found, LATE)
                fired = True
            else:
                for word, n in found.items():
                    words.setdefault(word, [0, 0])[1] += n
        if rows:
            yield pd.DataFrame(rows, columns=PANE_COLUMNS)
        if gone:
            state.remove()
            return
        state.update((fired, json.dumps(words)))
        # A timer goes off once the watermark is behind it.
        state.setTimeoutTimestamp(end - (size if fired else delay) - 1)

    return step


def windowed_panes(
    lines: DataFrame,
    size: str,
    lateness: str = "0 seconds",
    line: str = "line",
    ts: str = "ts",
    slices: int | None = None,
) -> DataFrame:
    """``window_start, window_end, word, pane, timing, is_last, n`` of a stream of lines, in append mode.

    ``pane`` numbers the firings of a word in a window from 0 on; ``timing`` says
    whether it fired in time. ``is_last`` tells that nothing can follow, because the
    event time was already beyond the allowed lateness; a window that waits for
    late rows in vain fires no empty pane. Start the query through
    ``streaming.runs``. The words of an open window are dealt by a hash into
    ``slices``, as many as there are tasks if not given; the state is a row per slice.
    """
    spark = lines.sparkSession
    length, late = milliseconds(spark, size), milliseconds(spark, lateness)
    timed = lines.select(ts, line).withWatermark(ts, f"{length + late} milliseconds")
    found = words(timed, line, pos=None)
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("word"), F.lit(slices)).cast("int")
    keyed = found.select(ts, F.unix_millis(F.window(ts, size).end).alias("end_ms"), part.alias("slice"), "word")
    panes = keyed.groupBy("end_ms", "slice").applyInPandasWithState(
        _fire(length, late), PANES, STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    return panes.select(
        F.timestamp_millis(F.col("end_ms") - length).alias("window_start"),
        F.timestamp_millis("end_ms").alias("window_end"),
        "word", "pane", "timing", "is_last", "n",
    )


def pane_stream(
    lines: DataFrame, size: str, path: str, checkpoint: str, lateness: str = "0 seconds", ts: str = "ts"
) -> DataStreamWriter:
    """Panes to parquet files, each exactly once."""
    return (
        windowed_panes(lines, size, lateness, ts=ts)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
