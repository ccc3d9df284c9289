"""A result after every element of a stream, and event times for its rows.

A micro-batch is a piece of the order: its rows come after those of all batches
before, whatever their own order columns say. Each batch is a prefix scan that
starts from the totals so far. They are one row, kept per batch id, so a batch that
runs again starts from where it started the first time and gives the same results.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from wordflow.functions.mergeable import ELEMENT_COUNT, Mergeable, Part, summed
from wordflow.operators.event_time import time_of
from wordflow.operators.running import running_combine, total_of
from wordflow.operators.tokens import words
from wordflow.sinks.batches import Sink
from wordflow.sinks.commits import Versions
from wordflow.streaming.runs import END_OF_TIME

# A part that no mergeable has.
ELEMENTS = "all_elements"


def counted(mergeable: Mergeable) -> Mergeable:
    """``mergeable`` with the number of its elements as one more part."""
    number: Part = summed(lambda element, order: F.lit(1).cast("bigint"))
    return Mergeable(mergeable.result, {**mergeable.parts, ELEMENTS: number}, mergeable.finish, mergeable.empty)


def _itself(rows: DataFrame) -> DataFrame:
    return rows


def advance(
    rows: DataFrame,
    batch_id: int,
    state: str,
    mergeable: Mergeable,
    order: Sequence[str],
    element: str = "word",
    expand: Callable[[DataFrame], DataFrame] = _itself,
    within: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """The results of one more batch of rows, and the totals behind it.

    Only ``rows`` and the one row of totals under ``state`` are read, so a table
    that grows by batches pays for what is new. The same call may be made again for
    the last batch. Arguments as for ``running_combine``, whose results these are
    if every batch lies behind the one before in ``order``.
    """
    held, versions = counted(mergeable), Versions(rows.sparkSession, state)
    start = versions.before(batch_id)
    versions.write(batch_id, total_of(rows, held, order, element, expand, within, start))
    results = running_combine(rows, held, order, element, expand, within, start=start)
    return results, versions.read(batch_id)


def timed_rows(
    rows: DataFrame, batch_id: int, state: str, order: Sequence[str], base: datetime, step_ms: int = 1, ts: str = "ts"
) -> DataFrame:
    """One more batch of rows with event times that go on where the batch before ended."""
    numbered, _ = advance(rows, batch_id, state, ELEMENT_COUNT, order)
    return numbered.select(*rows.columns, time_of(base, step_ms).alias(ts))


def running_elements(
    rows: DataFrame,
    mergeable: Mergeable,
    order: Sequence[str],
    sink: Sink,
    state: str,
    checkpoint: str,
    element: str = "word",
    expand: Callable[[DataFrame], DataFrame] = _itself,
    within: Sequence[str] = (),
    with_final: bool = False,
    with_default: bool = False,
    ts: str | None = "ts",
) -> DataStreamWriter:
    """A writer, ready to start, that hands ``sink`` each element with its result.

    ``sink`` may see a batch again after a failure, with the same results. A row of
    ``rows`` at the end of time (``run_to_end`` puts one) marks the end of input:
    ``with_final`` then gives the last result once more, with ``is_final`` true,
    and ``with_default`` the value over no elements if there was none at all.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            results, totals = advance(held, batch_id, state, mergeable, order, element, expand, within)
            if with_final or with_default:
                results = results.withColumn("is_final", F.lit(False))
                if ts is not None and not held.filter(F.col(ts) >= END_OF_TIME).isEmpty():
                    last = _last(totals, mergeable, with_final, with_default)
                    results = results.unionByName(last, allowMissingColumns=True)
            sink(results, batch_id)
        finally:
            held.unpersist()

    return rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)


def _last(totals: DataFrame, mergeable: Mergeable, with_final: bool, with_default: bool) -> DataFrame:
    """The final result, if one is wanted: a row or none."""
    some = F.col(ELEMENTS) > 0
    wanted = F.when(some, F.lit(with_final)).otherwise(F.lit(with_default))
    value = F.when(some, mergeable.finish({name: F.col(name) for name in mergeable.parts})).otherwise(
        F.lit(mergeable.empty)
    )
    found = totals.withColumn(ELEMENTS, F.coalesce(ELEMENTS, F.lit(0))).filter(wanted)
    return found.select(value.alias(mergeable.result), F.lit(True).alias("is_final"))


def running_words(
    lines: DataFrame,
    mergeable: Mergeable,
    order: Sequence[str],
    sink: Sink,
    state: str,
    checkpoint: str,
    line: str = "line",
    **options,
) -> DataStreamWriter:
    """``running_elements`` over the words of a stream of lines, as columns ``pos`` and ``element``."""
    return running_elements(
        lines, mergeable, order, sink, state, checkpoint,
        element="element", expand=lambda rows: words(rows, line, "element"), within=["pos"], **options,
    )


def timed_stream(
    rows: DataFrame,
    order: Sequence[str],
    base: datetime,
    sink: Sink,
    state: str,
    checkpoint: str,
    step_ms: int = 1,
    ts: str = "ts",
) -> DataStreamWriter:
    """A writer that hands ``sink`` the rows with event times: row ``i`` of the stream gets ``base + i * step_ms``.

    Rows are numbered through over all micro-batches, within one by ``order``. A
    batch that runs again, also after a restart, gives its rows the same times.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            sink(timed_rows(held, batch_id, state, order, base, step_ms, ts), batch_id)
        finally:
            held.unpersist()

    return rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
