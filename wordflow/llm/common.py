"""What the operators of this package share: words, packed rows, written tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordflow.session import shared_folder

# The white space of every word and line rule, and the letters that are lowered.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: str | None) -> list[bytes]:
    """Longest runs without ASCII white space, as UTF-8. ``bytes.split`` cuts at those six bytes."""
    return text.encode().split() if text else []


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder, read back.

    Cuts the lineage: an executor that is lost later costs no recomputation of
    what stands before. The planner also learns the table's true size.
    """
    spark = frame.sparkSession
    path = shared_folder(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Removes a ``written`` table that nothing will read again."""
    spark = table.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def packed(frame: DataFrame, name: str = "row") -> Column:
    """All columns as one struct, so that no name in the frame can clash with an own one."""
    return F.struct(*[F.col(f"`{c}`") for c in frame.columns]).alias(name)


def unpacked(columns: Sequence[str], added: Sequence[str], name: str = "row") -> list[Column]:
    """The packed columns again, then the added ones; an added one replaces a packed one of its name."""
    lowered = {c.lower() for c in added}
    kept = [F.col(f"{name}.`{c}`").alias(c) for c in columns if c.lower() not in lowered]
    return kept + [F.col(c) for c in added]


def documents_of(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``docs`` only, in their order."""
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
