"""Lines to words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordflow.functions.text import word_list


def _others(lines: DataFrame, line: str, *own: str | None) -> list[Column]:
    """The columns beside ``line``, none of which may have a name that is given out."""
    names = [name for name in lines.columns if name != line]
    if clash := {name.lower() for name in names} & {name.lower() for name in own if name}:
        raise ValueError(f"columns {sorted(clash)} are there already: rename them or give other names")
    return [lines[name] for name in names]


def words(
    lines: DataFrame, line: str = "line", word: str = "word", pos: str | None = "pos"
) -> DataFrame:
    """One row per word of ``line``; the other columns stay.

    ``pos`` counts the words of a line from 0, and is left out if it is None.
    Case is kept. A null line has no words.
    """
    others = _others(lines, line, word, pos)
    found = word_list(lines[line])
    if pos is None:
        return lines.select(*others, F.explode(found).alias(word))
    return lines.select(*others, F.posexplode(found).alias(pos, word))


def longest_words(
    lines: DataFrame, line: str = "line", word: str = "word", pos: str = "pos"
) -> DataFrame:
    """The first of the longest words of each line that has words, as ``words`` gives it."""
    others = _others(lines, line, word, pos)
    found = lines.select(*others, word_list(lines[line]).alias(word)).filter(F.size(word) > 0)
    lengths = F.transform(word, F.length)
    place = F.array_position(lengths, F.array_max(lengths)).cast("int") - 1
    return found.withColumn(pos, place).withColumn(word, F.get(word, pos)).select(
        *[name for name in lines.columns if name != line], pos, word
    )
