"""Lines, words and null handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. A word is a longest run of ASCII letters, digits and underscores,
# which is what a split on \W+ leaves once empty pieces are dropped.
WORD = r"\w+"
KEY_VALUE_SEPARATOR = " "


def word_list(line: Column) -> Column:
    """The words of a line, in their order, as an array."""
    return F.regexp_extract_all(line, F.lit(WORD), F.lit(0))


def null_to_empty(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def keyed_line(key: Column, value: Column) -> Column:
    """Key and value as one line. A null key still leaves the separator."""
    return F.concat(null_to_empty(key), F.lit(KEY_VALUE_SEPARATOR), null_to_empty(value))


def value_line(value: Column) -> Column:
    return null_to_empty(value)
