"""Counts per element, per window, and the top k of each window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WINDOW = ("window_start", "window_end")

# Names that no table has.
SLICE, RANK = "__slice", "__rank"


def count_per_element(elements: DataFrame, *by: str, n: str = "n") -> DataFrame:
    """Rows per distinct element. Frequent elements shrink before the shuffle."""
    return elements.groupBy(*(by or ("word",))).agg(F.count("*").alias(n))


def count_per_window(
    elements: DataFrame, size: str, *by: str, ts: str = "ts", n: str = "n"
) -> DataFrame:
    """Rows per distinct element in each fixed window, windows aligned to the epoch.

    On a stream ``ts`` must carry a watermark; each window comes out once.
    """
    keys = by or ("word",)
    counted = elements.groupBy(F.window(ts, size), *keys).agg(F.count("*").alias(n))
    return counted.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *keys,
        n,
    )


def top_k(counts: DataFrame, k: int, *group: str, element: str = "word", n: str = "n") -> DataFrame:
    """The ``k`` largest counts of each group; equal counts go by ``element``.

    One path for every ``k``: the words of a group are dealt into as many slices as
    there are tasks, by a hash, and each slice keeps its ``k`` best; what is left,
    ``k`` rows per slice at most, meets in the group's task. Sessions from
    ``build_session`` drop rows beyond ``k`` before each of the two shuffles too,
    for any ``k``.
    """
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    best_first = [F.col(n).desc(), F.col(element).asc()]
    in_slice = Window.partitionBy(*group, SLICE).orderBy(*best_first)
    in_group = Window.partitionBy(*group).orderBy(*best_first)
    sliced = counts.withColumn(SLICE, F.pmod(F.xxhash64(element), F.lit(tasks)))
    best = sliced.withColumn(RANK, F.row_number().over(in_slice)).filter(F.col(RANK) <= k)
    best = best.drop(SLICE, RANK)
    return best.withColumn("rank", F.row_number().over(in_group)).filter(F.col("rank") <= k)


def top_k_per_window(counts: DataFrame, k: int, element: str = "word", n: str = "n") -> DataFrame:
    """``top_k`` over the frame that ``count_per_window`` gives. Batch frames only."""
    return top_k(counts, k, *WINDOW, element=element, n=n)
