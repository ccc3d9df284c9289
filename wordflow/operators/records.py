"""Keyed records to lines, and results to keyed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordflow.functions.encoding import double_bytes, long_bytes, string_bytes
from wordflow.functions.text import keyed_line, value_line


def _without(df: DataFrame, *names: str) -> list[Column]:
    return [df[name] for name in df.columns if name not in names]


def keyed_lines(
    records: DataFrame, key: str = "key", value: str = "value", line: str = "line"
) -> DataFrame:
    """Key and value joined into one line; words of the key count too."""
    text = keyed_line(records[key], records[value])
    return records.select(*_without(records, key, value), text.alias(line))


def value_lines(
    records: DataFrame, key: str = "key", value: str = "value", line: str = "line"
) -> DataFrame:
    """The value alone as a line."""
    return records.select(*_without(records, key, value), value_line(records[value]).alias(line))


def with_key(elements: DataFrame, key: str = "", name: str = "key") -> DataFrame:
    """The same constant key on every row."""
    return elements.select(F.lit(key).alias(name), "*")


def _as_bytes(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        return long_bytes(df[name])
    if isinstance(kind, T.FractionalType):
        return double_bytes(df[name])
    return string_bytes(df[name])


def to_records(df: DataFrame, key: str = "key", value: str = "value", *kept: str) -> DataFrame:
    """``key binary, value binary``: integers and doubles take eight bytes, text is UTF-8.

    All other columns but ``kept``, window bounds too, are left behind.
    """
    return df.select(_as_bytes(df, key).alias("key"), _as_bytes(df, value).alias("value"), *kept)
