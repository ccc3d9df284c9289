"""Stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

# A session that reads small unsplittable files may ask for so many tasks behind them.
INPUT_TASKS = "spark.wordflow.inputTasks"


def spread(scan: DataFrame) -> DataFrame:
    """The rows dealt over as many tasks as the session asks for; as they are if it does not.

    This shuffles the rows. It pays only where a table is a file or two and cannot
    be split, so nothing but the setting turns it on.
    """
    tasks = scan.sparkSession.conf.get(INPUT_TASKS, None)
    return scan.repartition(int(tasks)) if tasks else scan
