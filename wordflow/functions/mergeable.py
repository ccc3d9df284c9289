"""Aggregates given as parts that can be computed apart and merged.

One ``Mergeable`` serves ``groupBy().agg``, the running scan over ordered rows,
and update-mode streams: Spark's partial aggregation does the adding, its final
aggregation the merging.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

Lift = Callable[[Column, Sequence[Column]], Column]


@dataclass(frozen=True)
class Part:
    """One field of the accumulator.

    ``lift`` turns an element and its order numbers into a value, ``total`` is
    the built-in aggregate over such values, ``merge`` joins two totals; a null
    total stands for "nothing yet".
    """

    lift: Lift
    total: Callable[[Column], Column]
    merge: Callable[[Column, Column], Column]


@dataclass(frozen=True)
class Mergeable:
    """``result`` names the output column, ``finish`` makes it from the totals.

    ``empty`` is the value over no elements at all.
    """

    result: str
    parts: dict[str, Part]
    finish: Callable[[dict[str, Column]], Column]
    empty: int | float | str | None = None

    def lifted(self, element: Column, order: Sequence[Column]) -> list[Column]:
        return [part.lift(element, order).alias(name) for name, part in self.parts.items()]

    def totals(self) -> list[Column]:
        return [part.total(F.col(name)).alias(name) for name, part in self.parts.items()]


def summed(lift: Lift) -> Part:
    return Part(lift, F.sum, lambda a, b: F.coalesce(a + b, a, b))


def greatest(lift: Lift) -> Part:
    return Part(lift, F.max, F.greatest)


def _longest_first(element: Column, order: Sequence[Column]) -> Column:
    # Complements turn an order round and overflow nowhere: among words of one length
    # the earliest is greatest. Nulls come first in an order, so their flag is greatest.
    earliest = [
        column
        for i, number in enumerate(order)
        for column in (
            number.isNull().alias(f"null_{i}"),
            F.bitwise_not(number).alias(f"order_{i}"),
        )
    ]
    return F.struct(F.length(element).alias("length"), *earliest, element.alias("word"))


ELEMENT_COUNT = Mergeable(
    result="n",
    parts={"count": summed(lambda element, order: F.lit(1).cast("bigint"))},
    finish=lambda totals: totals["count"],
    empty=0,
)

AVERAGE_LENGTH = Mergeable(
    result="avg_len",
    parts={
        "sum_len": summed(lambda element, order: F.length(element).cast("bigint")),
        "count": summed(lambda element, order: F.lit(1).cast("bigint")),
    },
    finish=lambda totals: totals["sum_len"] / totals["count"],
    empty=float("nan"),
)

LONGEST_WORD = Mergeable(
    result="word",
    parts={"longest": greatest(_longest_first)},
    finish=lambda totals: totals["longest"]["word"],
)
