"""Total orders over rows, and their cut into ranges of about equal size."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Makes shares differ by some 15 percent.
SAMPLES_PER_RANGE = 50
# A name that no table has.
KEY = "__order_key"


def _micros(local: Column) -> Column:
    """Microseconds of a time without zone. A cast would use the session's zone and its jumps."""
    days = F.unix_date(local.cast("date")).cast("bigint")
    minutes = (days * 24 + F.hour(local)) * 60 + F.minute(local)
    seconds = F.extract(F.lit("SECOND"), local)  # with six decimals
    return minutes * 60_000_000 + (seconds * 1_000_000).cast("bigint")


def order_number(rows: DataFrame, name: str) -> Column:
    """An integer or timestamp column as a bigint that sorts the same way."""
    kind = rows.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        return rows[name].cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(rows[name])
    if isinstance(kind, T.TimestampNTZType):
        return _micros(rows[name])
    raise TypeError(f"cannot order by {name}: {kind.simpleString()} is neither integer nor timestamp")


def order_numbers(rows: DataFrame, order: Sequence[str]) -> list[Column]:
    return [order_number(rows, name) for name in order]


def _key_names(order: Sequence[str]) -> list[str]:
    return [f"key_{level}" for level in range(len(order))]


def split_points(rows: DataFrame, order: Sequence[str], ranges: int) -> list[tuple[int, ...]]:
    """Keys, in ascending order, that cut ``rows`` into about ``ranges`` equal shares.

    Whole keys are cut, so rows with a common first column are spread as well.
    The cuts are quantiles of a sample of the keys alone, whose size depends on
    ``ranges`` and not on the rows; only how even the shares are depends on it.
    """
    if ranges == 1:
        return []
    names = _key_names(order)
    keys = rows.select(*[n.alias(k) for n, k in zip(order_numbers(rows, order), names)])
    count = keys.count()
    wanted = ranges * SAMPLES_PER_RANGE
    if count > wanted:
        keys = keys.sample(wanted / count, seed=7)
    step = max(1, math.ceil(min(count, wanted) / ranges))
    # At most about ``wanted`` rows, so one task is enough here.
    placed = keys.withColumn("place", F.row_number().over(Window.orderBy(*names)))
    cuts = placed.filter((F.col("place") % step == 0) & (F.col("place") < count))
    return list(dict.fromkeys(tuple(row) for row in cuts.orderBy("place").select(*names).collect()))


def with_range(
    rows: DataFrame, order: Sequence[str], points: list[tuple[int, ...]], name: str
) -> DataFrame:
    """``rows`` and, as column ``name``, how many of ``points`` lie before a row's key.

    A binary search, one projection per step, each with the points it may meet.
    """
    names = _key_names(order)
    fields = ", ".join(f"{key}: bigint" for key in names)
    key = F.struct(*[n.alias(k) for n, k in zip(order_numbers(rows, order), names)])
    placed = rows.withColumns({name: F.lit(0), KEY: key})
    for bit in reversed(range(len(points).bit_length())):
        step = 2**bit
        text = json.dumps([dict(zip(names, point)) for point in points[step - 1 :: 2 * step]])
        table = F.from_json(F.lit(text), f"array<struct<{fields}>>")
        point = F.get(table, F.shiftright(name, bit + 1))
        placed = placed.withColumn(
            name, F.when(point < F.col(KEY), F.col(name) + step).otherwise(F.col(name))
        )
    return placed.drop(KEY)
