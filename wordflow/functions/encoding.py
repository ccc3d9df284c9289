"""Bytes of record keys and values, in the formats Kafka's public serialisers use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def string_bytes(value: Column) -> Column:
    """UTF-8 bytes."""
    return value.cast("binary")


def long_bytes(value: Column) -> Column:
    """Eight bytes, big-endian, two's complement."""
    return F.unhex(F.lpad(F.hex(value.cast("bigint")), 16, "0"))


def double_bytes(value: Column) -> Column:
    """Eight bytes, big-endian, IEEE 754 double."""
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value.cast("double"))
    return long_bytes(F.when(value.isNotNull(), bits))
