"""The top k over all closed windows of a stream so far."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from wordflow.operators.top import ENTRY, best_entries, entries_of, running_top_k
from wordflow.plans.words import windowed_word_count
from wordflow.sinks.batches import Sink
from wordflow.sinks.commits import Versions


def top_k_so_far_stream(
    lines: DataFrame,
    size: str,
    k: int,
    sink: Sink,
    state: str,
    checkpoint: str,
    ts: str = "ts",
    lateness: str = "0 seconds",
) -> DataStreamWriter:
    """After each closed window the ``k`` largest counts of all windows closed so far.

    ``sink`` gets the rows of ``running_top_k`` for the windows that a micro-batch
    closes. What goes on from batch to batch are ``k`` entries, kept per batch id, so
    a batch that runs again gives the same rows.
    """
    counts = windowed_word_count(lines, size, ts=ts, lateness=lateness)

    def step(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            versions = Versions(batch.sparkSession, state)
            start = versions.before(batch_id)
            entries = entries_of(held.filter(F.col("word").isNotNull()), k).select(*ENTRY)
            versions.write(batch_id, best_entries(entries if start is None else entries.unionByName(start), k))
            sink(running_top_k(held, k, start=start), batch_id)
        finally:
            held.unpersist()

    return (
        counts.writeStream.outputMode("append")
        .foreachBatch(step)
        .option("checkpointLocation", checkpoint)
    )
