"""Results over all elements so far, one after each micro-batch.

Per-element results need a total order, which a stream does not have: see
``wordflow.operators.running`` for bounded input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from wordflow.functions.mergeable import Mergeable
from wordflow.operators.order import order_numbers
from wordflow.sinks.batches import Sink


# A name that no mergeable part has.
ELEMENTS = "__elements"


def combine_so_far(
    elements: DataFrame,
    mergeable: Mergeable,
    element: str = "word",
    order: Sequence[str] = (),
    repeat_last: bool = False,
) -> DataFrame:
    """One row of state, updated by every micro-batch, for update mode.

    There is no result before the first element, so a stream has no default result:
    ``Mergeable.empty`` stands for a bounded input that ended without any.
    Without ``repeat_last`` a batch without elements gives no result. With it
    the last result comes once more when a watermark on ``elements`` moves on
    without them, as it does at the end of available input.
    """
    lifted = mergeable.lifted(F.col(element), order_numbers(elements, order))
    rows = elements.select(*lifted)
    grouped = rows.groupBy() if repeat_last else rows.groupBy(F.lit(0).alias("all"))
    totals = grouped.agg(*mergeable.totals(), F.count("*").alias(ELEMENTS)).filter(F.col(ELEMENTS) > 0)
    value = mergeable.finish({name: F.col(name) for name in mergeable.parts})
    return totals.select(value.alias(mergeable.result))


def running_stream(results: DataFrame, sink: Sink, checkpoint: str) -> DataStreamWriter:
    """A writer, ready to start, that hands each update to ``sink``."""
    return (
        results.writeStream.outputMode("update")
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
    )
