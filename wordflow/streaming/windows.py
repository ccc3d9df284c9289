"""Results of fixed windows, given once, when the watermark passes their end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from wordflow.operators.counts import top_k_per_window
from wordflow.plans.words import windowed_word_count
from wordflow.sinks.batches import Sink


def count_stream(
    lines: DataFrame,
    size: str,
    path: str,
    checkpoint: str,
    ts: str = "ts",
    lateness: str = "0 seconds",
) -> DataStreamWriter:
    """Word counts of closed windows to parquet files, each row exactly once."""
    counts = windowed_word_count(lines, size, ts=ts, lateness=lateness)
    return (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def top_k_stream(
    lines: DataFrame,
    size: str,
    k: int,
    sink: Sink,
    checkpoint: str,
    ts: str = "ts",
    lateness: str = "0 seconds",
) -> DataStreamWriter:
    """Top k words of closed windows, ranked in the micro-batch that closes them.

    In append mode all counts of a window come in one micro-batch, so the ranks
    are exact. ``sink`` may see a batch again after a failure; an ``Outbox`` delivers
    it once.
    """
    counts = windowed_word_count(lines, size, ts=ts, lateness=lateness)

    def rank(batch: DataFrame, batch_id: int) -> None:
        sink(top_k_per_window(batch, k), batch_id)

    return (
        counts.writeStream.outputMode("append")
        .foreachBatch(rank)
        .option("checkpointLocation", checkpoint)
    )
