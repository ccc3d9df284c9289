"""Results after every element, over rows in a total order."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordflow.functions.mergeable import Mergeable
from wordflow.operators.order import order_numbers, split_points, with_range

# A name that no table has.
RANGE = "__order_range"
# The range of totals that come before all rows.
BEFORE_ALL = -1


def _one_element_per_row(rows: DataFrame) -> DataFrame:
    return rows


def total_of(
    rows: DataFrame,
    mergeable: Mergeable,
    order: Sequence[str],
    element: str = "word",
    expand: Callable[[DataFrame], DataFrame] = _one_element_per_row,
    within: Sequence[str] = (),
    start: DataFrame | None = None,
) -> DataFrame:
    """One row with the parts of the accumulator over ``start`` and all rows, null without elements.

    Every task reduces its share to one row; only those rows meet.
    """
    elements = expand(rows)
    lifted = mergeable.lifted(F.col(element), order_numbers(elements, [*order, *within]))
    totals = elements.select(*lifted).agg(*mergeable.totals())
    if start is None:
        return totals
    return totals.unionByName(start.select(*mergeable.parts)).agg(*mergeable.totals())


def running_combine(
    rows: DataFrame,
    mergeable: Mergeable,
    order: Sequence[str],
    element: str = "word",
    expand: Callable[[DataFrame], DataFrame] = _one_element_per_row,
    within: Sequence[str] = (),
    expand_for_totals: Callable[[DataFrame], DataFrame] | None = None,
    ranges: int | None = None,
    with_final: bool = False,
    start: DataFrame | None = None,
) -> DataFrame:
    """Each element with the combined value of all elements up to it.

    ``order`` must identify a row. ``expand`` turns a row into its elements
    (words of a line, say), ordered by the columns ``within`` that it adds; rows
    are moved before they are expanded. ``expand_for_totals`` may leave out
    elements that do not change a total. ``with_final`` adds a column ``is_final``
    and one more row that holds the last result and no element. ``start`` is a row
    of totals (``total_of``) that come before all rows.

    This is a prefix scan: the rows are cut into ranges of the order, one per
    task; each range is totalled; the totals before a range, put together, are
    the start value of the running results inside it. The cuts are fixed numbers
    in the plan, so a lost task recomputes the same range. ``rows`` is read four
    times, twice for its order columns only; write a costly frame to a table first.
    """
    ranges = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = split_points(rows, order, ranges)
    tasks = len(points) + 1
    full_order = [*order, *within]
    parts = mergeable.parts.items()

    placed = with_range(rows, order, points, RANGE)
    still = (expand_for_totals or expand)(placed)
    totals = (
        still.select(RANGE, *mergeable.lifted(F.col(element), order_numbers(still, full_order)))
        .groupBy(RANGE)
        .agg(*mergeable.totals())
    )
    if start is not None:
        totals = totals.unionByName(start.select(F.lit(BEFORE_ALL).alias(RANGE), *mergeable.parts))
    # One row per range, so one task is enough here.
    earlier = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        RANGE, *[part.total(F.col(name)).over(earlier).alias(f"start_{name}") for name, part in parts]
    )

    # Range i goes to task i, and so does its start value: whatever join Spark
    # picks for them, the rows are not moved again.
    starts = starts.filter(F.col(RANGE) > BEFORE_ALL).repartitionById(tasks, F.col(RANGE))
    moved = expand(placed.repartitionById(tasks, F.col(RANGE)))
    so_far = (
        Window.partitionBy(RANGE)
        .orderBy(*full_order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    numbers = order_numbers(moved, full_order)
    local = moved.select(
        *moved.columns,
        *[
            part.total(part.lift(F.col(element), numbers)).over(so_far).alias(f"local_{name}")
            for name, part in parts
        ],
    )
    merged = {
        name: part.merge(F.col(f"start_{name}"), F.col(f"local_{name}")) for name, part in parts
    }
    shown = [name for name in moved.columns if name != RANGE]
    running = local.join(starts, RANGE, "left").select(
        *shown, mergeable.finish(merged).alias(mergeable.result)
    )
    if not with_final:
        return running
    last = (
        totals.agg(*mergeable.totals(), F.count("*").alias("ranges"))
        .filter("ranges > 0")
        .select(mergeable.finish({name: F.col(name) for name, _ in parts}).alias(mergeable.result))
    )
    return running.withColumn("is_final", F.lit(False)).unionByName(
        last.withColumn("is_final", F.lit(True)), allowMissingColumns=True
    )
