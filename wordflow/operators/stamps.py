"""Clean-up of lines that start with a date."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
SEPARATOR = ";"
STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ssxxx"

# Outcomes: accepted, and the reasons for a reject.
ACCEPTED = "accepted"
MISSING_SEMICOLON = "missing_semicolon"
UNPARSABLE_DATE = "unparsable_date"

DATE_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "yyyy-MM-dd'T'HH:mm:ss",
    STAMP_FORMAT,
    "yyyy/MM/dd HH:mm:ss",
    "dd.MM.yyyy",
)


def _shape(date_format: str) -> str | None:
    """A regular expression for all dates of a format of numbers only, else None."""
    shape = ""
    for run in re.finditer(r"'([^']*)'|([A-Za-z])\2*|[^A-Za-z']", date_format):
        text, quoted, letter = run.group(0, 1, 2)
        if quoted is not None:
            shape += re.escape(quoted)
        elif letter is None and text not in "[]{}#":
            shape += re.escape(text)
        elif letter and letter in "xX":
            shape += r"(?:Z|[+-][\d:]+)"
        elif letter and letter in "MdHms" and len(text) == 2:
            shape += r"\d{2}"
        elif letter and letter in "yMdHmsS" and (letter != "M" or len(text) == 1):
            shape += r"[+-]?\d+"
        else:
            return None
    return f"^{shape}$"


def _read_date(date: Column, date_format: str) -> Column:
    """The date as a timestamp, or null. A failed attempt to read is slow, so most are avoided."""
    read = F.try_to_timestamp(date, F.lit(date_format))
    shape = _shape(date_format)
    return F.when(date.rlike(shape), read) if shape else read


def judge_stamps(
    lines: DataFrame, formats: Sequence[str] = DATE_FORMATS, line: str = "line"
) -> DataFrame:
    """The lines with ``date``, ``rest``, ``stamp`` and ``outcome``, each line read once.

    ``outcome`` is ``ACCEPTED`` or says why the line is rejected. ``stamp`` is in
    ISO form with seconds and the session zone's offset, null for rejects. The
    first of ``formats`` that reads the date counts.
    """
    halves = F.split(F.btrim(lines[line], F.lit(" \t")), SEPARATOR, 2)
    cut = lines.select(
        *[lines[name] for name in lines.columns],
        halves[0].alias("date"),
        F.coalesce(F.get(halves, 1), F.lit("")).alias("rest"),
    )
    read = F.coalesce(*[_read_date(F.col("date"), each) for each in formats])
    # Exploded, so that what follows does not read the date a second time.
    stamped = cut.select("*", F.explode(F.array(F.date_format(read, STAMP_FORMAT))).alias("stamp"))
    complete = (F.col("date") != "") & (F.col("rest") != "")
    outcome = (
        F.when(complete, F.when(F.col("stamp").isNull(), UNPARSABLE_DATE).otherwise(ACCEPTED))
        .otherwise(MISSING_SEMICOLON)
        .alias("outcome")
    )
    complete_stamp = F.when(complete, F.col("stamp"))
    return stamped.select("*", outcome).withColumn("stamp", complete_stamp)


def cleaned(judged: DataFrame, line: str = "line") -> DataFrame:
    """``line`` as it goes out: ``stamp;rest`` where it was accepted, the line itself where not."""
    joined = F.concat_ws(SEPARATOR, "stamp", "rest")
    shown = F.when(F.col("outcome") == ACCEPTED, joined).otherwise(F.col(line))
    return judged.withColumn(line, shown).drop("date", "rest", "stamp")


def write_stamps(judged: DataFrame, folder: str, line: str = "line") -> None:
    """Cleaned lines and rejects to a folder per outcome, in one pass."""
    cleaned(judged, line).write.partitionBy("outcome").parquet(folder)


def normalise_stamps(
    lines: DataFrame, formats: Sequence[str] = DATE_FORMATS, line: str = "line"
) -> tuple[DataFrame, DataFrame]:
    """Lines ``date;rest`` as (accepted, rejected) frames; other columns stay.

    Accepted rows have ``stamp`` and ``rest``; rejected rows keep the line and say
    why in ``reason``. A job that wants both should write ``judge_stamps`` once.
    """
    names = [name for name in lines.columns if name != line]
    judged = judge_stamps(lines, formats, line)
    accepted = judged.filter(F.col("outcome") == ACCEPTED).select(*names, "stamp", "rest")
    rejected = judged.filter(F.col("outcome") != ACCEPTED)
    return accepted, rejected.select(*names, line, F.col("outcome").alias("reason"))
