"""Panes of windows: on time, late, last."""

import pytest
from pyspark.sql import functions as F

from wordflow.sources.replay import fed_stream, staged_parts
from wordflow.streaming.panes import milliseconds, pane_stream
from wordflow.streaming.runs import run_to_end


@pytest.fixture
def panes(spark, lines, tmp_path):
    def run(*batches, size="10 seconds", lateness="0 seconds"):
        pairs = [(s, text) for batch in batches for s, text in batch]
        number = [n for n, batch in enumerate(batches) for _ in batch]
        rows = lines(*pairs)
        part = F.get(F.array(*[F.lit(n) for n in number]), F.col("id").cast("int"))
        folder, feed = str(tmp_path), str(tmp_path / "in")
        parts = staged_parts(rows, f"{folder}/parts", part)
        stream = fed_stream(spark, feed, rows.schema)
        run_to_end(
            stream, f"{folder}/end",
            lambda s: pane_stream(s, size, f"{folder}/out", f"{folder}/state", lateness), parts=parts, feed=feed,
        )
        found = spark.read.parquet(f"{folder}/out").orderBy("window_start", "word", "pane").collect()
        return [(r.window_start.second, r.word, r.pane, r.timing, r.is_last, r.n) for r in found]

    return run


def test_windows_fire_once_without_late_rows(panes):
    assert panes([(0, "a a")], [(3, "a b")], [(12, "c")]) == [
        (0, "a", 0, "on_time", True, 3), (0, "b", 0, "on_time", True, 1), (10, "c", 0, "on_time", True, 1),
    ]


def test_late_rows_are_a_pane_of_their_own(panes):
    got = panes(
        [(0, "a a")], [(12, "c")], [(3, "a b")], [(4, "a"), (14, "c")], [(31, "d")], [(5, "gone")],
        lateness="15 seconds",
    )
    assert got == [
        (0, "a", 0, "on_time", False, 2), (0, "a", 1, "late", False, 1), (0, "a", 2, "late", False, 1),
        (0, "b", 0, "late", False, 1), (10, "c", 0, "on_time", False, 2), (30, "d", 0, "on_time", True, 1),
    ]


def test_without_lateness_they_are_dropped(panes):
    assert panes([(0, "a")], [(12, "c")], [(3, "a b")]) == [(0, "a", 0, "on_time", True, 1), (10, "c", 0, "on_time", True, 1)]


def test_a_jump_over_the_lateness_makes_the_first_pane_the_last(panes):
    got = panes([(0, "a")], [(50, "b")], [(3, "a")], lateness="15 seconds")
    assert got == [(0, "a", 0, "on_time", True, 1), (50, "b", 0, "on_time", True, 1)]


def test_a_row_at_the_end_of_a_window_opens_the_next(panes):
    """The event time reaches a window's end exactly: it fires."""
    got = panes([(0, "a")], [(10, "b")], [(9.999, "a")], lateness="1 second")
    assert got == [(0, "a", 0, "on_time", False, 1), (0, "a", 1, "late", False, 1), (10, "b", 0, "on_time", True, 1)]


def test_lengths_of_time(spark):
    assert milliseconds(spark, "6 hours") == 21_600_000 and milliseconds(spark, "0 seconds") == 0
