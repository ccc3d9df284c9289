"""One result over all elements of a frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordflow.functions.mergeable import Mergeable
from wordflow.operators.order import order_numbers


def combine_globally(
    elements: DataFrame,
    mergeable: Mergeable,
    element: str = "word",
    order: Sequence[str] = (),
    with_default: bool = True,
) -> DataFrame:
    """A single row with the combined value.

    Every task reduces its share to one row; only those rows meet. Without
    elements the row holds ``mergeable.empty``, or is left out when
    ``with_default`` is false. ``order`` decides ties where the mergeable has any.
    """
    lifted = mergeable.lifted(F.col(element), order_numbers(elements, order))
    combined = (
        elements.select(*lifted)
        .agg(*mergeable.totals(), F.count("*").alias("elements"))
    )
    if not with_default:
        combined = combined.filter("elements > 0")
    value = mergeable.finish({name: F.col(name) for name in mergeable.parts})
    if mergeable.empty is not None:
        value = F.coalesce(value, F.lit(mergeable.empty))
    return combined.select(value.alias(mergeable.result))
