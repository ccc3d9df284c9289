"""Micro-batch results as files that a repeated batch overwrites."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

Sink = Callable[[DataFrame, int], None]


def batch_folders(path: str) -> Sink:
    """For ``foreachBatch``: parquet under ``path/batch_id=<n>``.

    A batch that runs again after a failure replaces its own folder, so no row
    is there twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write
