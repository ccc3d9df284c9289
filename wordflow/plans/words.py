"""The word jobs over frames of lines, batch and stream alike where Spark allows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from wordflow.functions.mergeable import AVERAGE_LENGTH, LONGEST_WORD
from wordflow.operators.combine import combine_globally
from wordflow.operators.counts import count_per_element, count_per_window, top_k_per_window
from wordflow.operators.running import running_combine
from wordflow.operators.tokens import longest_words, words


def word_count(lines: DataFrame, line: str = "line") -> DataFrame:
    """``word, n``: how often each word occurs."""
    return count_per_element(words(lines.select(line), line, pos=None))


def windowed_word_count(
    lines: DataFrame,
    size: str = "3 seconds",
    line: str = "line",
    ts: str = "ts",
    lateness: str = "0 seconds",
) -> DataFrame:
    """``window_start, window_end, word, n``: the same per fixed window of event time.

    On a stream, rows later than ``lateness`` are dropped.
    """
    timed = lines.select(ts, line)
    if lines.isStreaming:
        timed = timed.withWatermark(ts, lateness)
    return count_per_window(words(timed, line, pos=None), size, ts=ts)


def top_k_words(
    lines: DataFrame, size: str, k: int, line: str = "line", ts: str = "ts"
) -> DataFrame:
    """``window_start, window_end, word, n, rank``: the k most frequent words of each window.

    For streams see ``wordflow.streaming.windows.top_k_stream``.
    """
    return top_k_per_window(windowed_word_count(lines, size, line, ts), k)


def longest_word(lines: DataFrame, order: Sequence[str], line: str = "line") -> DataFrame:
    """``word``: the longest; the earliest in ``order`` among equally long ones."""
    found = words(lines.select(*order, line), line)
    return combine_globally(found, LONGEST_WORD, order=[*order, "pos"], with_default=False)


def average_word_length(
    lines: DataFrame, line: str = "line", with_default: bool = True
) -> DataFrame:
    """``avg_len``: NaN without words, or no row then if ``with_default`` is false."""
    return combine_globally(
        words(lines.select(line), line, pos=None), AVERAGE_LENGTH, with_default=with_default
    )


def running_longest_word(
    lines: DataFrame,
    order: Sequence[str],
    line: str = "line",
    ranges: int | None = None,
    with_final: bool = True,
) -> DataFrame:
    """After each ``element`` the longest ``word`` so far, and the last one once more."""
    return running_combine(
        lines,
        LONGEST_WORD,
        order,
        element="element",
        expand=lambda rows: words(rows, line, "element"),
        within=["pos"],
        expand_for_totals=lambda rows: longest_words(rows, line, "element"),
        ranges=ranges,
        with_final=with_final,
    )


def running_average_word_length(
    lines: DataFrame,
    order: Sequence[str],
    line: str = "line",
    ranges: int | None = None,
    with_final: bool = False,
) -> DataFrame:
    """After each ``element`` the average word length ``avg_len`` so far."""
    return running_combine(
        lines,
        AVERAGE_LENGTH,
        order,
        element="element",
        expand=lambda rows: words(rows, line, "element"),
        within=["pos"],
        ranges=ranges,
        with_final=with_final,
    )
