"""Streams fed by one parquet file per step, so the micro-batches are known."""

import os
import time
from datetime import datetime

import pytest
from conftest import TOP_K_LINES, TOP_K_RESULT

from wordflow.functions.mergeable import AVERAGE_LENGTH, LONGEST_WORD
from wordflow.operators.tokens import words
from wordflow.plans import catalog
from wordflow.plans.catalog import QUERIES, _in_turn, _timed_event_lines
from wordflow.plans.words import windowed_word_count
from wordflow.sinks.batches import batch_folders
from wordflow.sources.replay import replay_stream
from wordflow.streaming.running import combine_so_far, running_stream
from wordflow.streaming.runs import run_available, run_to_end, stream_settings
from wordflow.streaming.windows import count_stream, top_k_stream

@pytest.fixture
def replay(spark, lines, tmp_path):
    """A stream of files, each with the given (second, text) rows."""

    def build(*files, files_per_trigger=1):
        folder = tmp_path / "in"
        folder.mkdir()
        for i, pairs in enumerate(files):
            # Ids go on from file to file, so that they identify a row.
            frame = lines(*pairs).selectExpr("ts", f"id + {100 * i} as id", "line")
            frame.coalesce(1).write.parquet(str(tmp_path / f"step{i}"))
            (part,) = (tmp_path / f"step{i}").glob("*.parquet")
            target = folder / f"{i}.parquet"
            target.write_bytes(part.read_bytes())
            at = time.time() - 1000 + i
            os.utime(target, (at, at))
        schema = lines((0, "a")).schema
        return replay_stream(spark, str(folder), schema, files_per_trigger=files_per_trigger)

    return build


def by_batch(spark, path, name):
    rows = spark.read.parquet(path).orderBy("batch_id").collect()
    return [row[name] for row in rows]


def test_top_k_golden(spark, replay, tmp_path):
    source = replay(TOP_K_LINES[:2], TOP_K_LINES[2:4], TOP_K_LINES[4:])
    out = str(tmp_path / "out")
    run_to_end(
        source,
        str(tmp_path / "end"),
        lambda lines: top_k_stream(
            lines, "10 seconds", 3, batch_folders(out), str(tmp_path / "state")
        ),
    )
    rows = spark.read.parquet(out).orderBy("window_start", "rank").collect()
    assert [(row.word, row.n) for row in rows] == TOP_K_RESULT


# Inputs and results of the two running examples.


def test_longest_word_golden(spark, replay, tmp_path):
    source = replay([(0, "a")], [(10, "bb")], [(20, "ccc")], [(30, "d")])
    so_far = combine_so_far(
        words(source.withWatermark("ts", "0 seconds")),
        LONGEST_WORD,
        order=["ts", "id", "pos"],
        repeat_last=True,
    )
    out = str(tmp_path / "out")
    run_available(spark, running_stream(so_far, batch_folders(out), str(tmp_path / "state")))
    assert by_batch(spark, out, "word") == ["a", "bb", "ccc", "ccc", "ccc"]


def test_no_result_before_the_first_word(spark, replay, tmp_path):
    source = replay([(0, "?")], [(10, "a")], [(20, "?")], [(30, "bb")])
    so_far = combine_so_far(
        words(source.withWatermark("ts", "0 seconds")),
        LONGEST_WORD,
        order=["ts", "id", "pos"],
        repeat_last=True,
    )
    out = str(tmp_path / "out")
    run_available(spark, running_stream(so_far, batch_folders(out), str(tmp_path / "state")))
    assert by_batch(spark, out, "word") == ["a", "a", "bb", "bb"]


def test_average_golden(spark, replay, tmp_path):
    source = replay([(0, "a")], [(10, "bb")], [(15, "?")], [(20, "ccc")])
    so_far = combine_so_far(words(source, pos=None), AVERAGE_LENGTH)
    out = str(tmp_path / "out")
    run_available(spark, running_stream(so_far, batch_folders(out), str(tmp_path / "state")))
    assert by_batch(spark, out, "avg_len") == [1.0, 1.5, 2.0]


def test_longest_word_keeps_the_earliest_over_batches(spark, replay, tmp_path):
    source = replay([(5, "bbb")], [(1, "aaa")], [(9, "ccc")])
    so_far = combine_so_far(words(source), LONGEST_WORD, order=["ts", "id", "pos"])
    out = str(tmp_path / "out")
    run_available(spark, running_stream(so_far, batch_folders(out), str(tmp_path / "state")))
    assert by_batch(spark, out, "word") == ["bbb", "aaa", "aaa"]


def counts_of(spark, source, tmp_path, size="10 seconds", end=True, **options):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    if end:
        run_to_end(
            source, str(tmp_path / "end"), lambda lines: count_stream(lines, size, out, state, **options)
        )
    else:
        run_available(spark, count_stream(source, size, out, state, **options))
    rows = spark.read.parquet(out).orderBy("window_start", "word").collect()
    return [(row.window_start.minute * 60 + row.window_start.second, row.word, row.n) for row in rows]


def test_windows_equal_the_batch_form(spark, replay, lines, tmp_path):
    found = counts_of(spark, replay(TOP_K_LINES[:3], TOP_K_LINES[3:]), tmp_path)
    batch = windowed_word_count(lines(*TOP_K_LINES), "10 seconds")
    wanted = batch.orderBy("window_start", "word").collect()
    assert found == [(row.window_start.second, row.word, row.n) for row in wanted]


def test_without_an_end_the_last_window_stays_open(spark, replay, tmp_path):
    source = replay([(0, "a")], [(10, "b")])
    assert counts_of(spark, source, tmp_path, end=False) == [(0, "a", 1)]


def test_late_rows_are_dropped(spark, replay, tmp_path):
    source = replay([(0, "a")], [(12, "b")], [(3, "late")], [(13, "b")], [(25, "c")])
    assert counts_of(spark, source, tmp_path) == [(0, "a", 1), (10, "b", 2), (20, "c", 1)]


def test_late_rows_count_within_the_lateness(spark, replay, tmp_path):
    source = replay([(0, "a")], [(12, "b")], [(3, "a")], [(25, "c")], [(4, "late")])
    found = counts_of(spark, source, tmp_path, lateness="5 seconds")
    assert found == [(0, "a", 2), (10, "b", 1), (20, "c", 1)]


def test_row_behind_its_neighbours_in_an_open_window_counts(spark, replay, tmp_path):
    source = replay([(8, "a")], [(2, "a")], [(11, "b")])
    assert counts_of(spark, source, tmp_path) == [(0, "a", 2), (10, "b", 1)]


def test_a_repeated_batch_replaces_its_rows(spark, tmp_path):
    write = batch_folders(str(tmp_path))
    write(spark.createDataFrame([("a", 1)], "word string, n bigint"), 3)
    write(spark.createDataFrame([("a", 2)], "word string, n bigint"), 3)
    assert [tuple(row) for row in spark.read.parquet(str(tmp_path)).collect()] == [("a", 2, 3)]


def test_a_run_to_the_end_may_be_repeated(spark, replay, tmp_path):
    source = replay([(0, "a")], [(10, "b")])
    wanted = [(0, "a", 1), (10, "b", 1)]
    assert counts_of(spark, source, tmp_path) == wanted
    assert counts_of(spark, source, tmp_path) == wanted


def test_settings_are_given_back(spark):
    key = "spark.sql.streaming.statefulOperator.allowMultiple"
    before = spark.conf.get(key)
    with stream_settings(spark):
        assert spark.conf.get(key) == "false"
    assert spark.conf.get(key) == before


def test_end_leaves_no_rows_of_its_own(spark, replay, tmp_path):
    found = counts_of(spark, replay([(0, "a")]), tmp_path)
    assert found == [(0, "a", 1)]
    assert spark.read.parquet(str(tmp_path / "end")).first().ts == datetime(9999, 1, 1)


STREAM_QUERIES = [
    "stream_windowed_word_count",
    "stream_windowed_word_count_late",
    "stream_top_k_words",
    "stream_longest_word",
    "stream_average_word_length",
]


@pytest.mark.parametrize("name", STREAM_QUERIES)
def test_queries_take_a_table_as_file_or_folder(spark, tmp_path, name):
    """The same rows for both layouts, from more than one micro-batch with data."""
    source = "/root/testdata/sf0.001/events.parquet"
    spark.read.parquet(source).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    seen = []
    for sf_dir in (os.path.dirname(source), str(tmp_path)):
        rows = QUERIES[name](spark, sf_dir).collect()
        seen.append(sorted(map(str, rows)))
    assert seen[0] == seen[1] and seen[0]
    assert len(_in_turn(_timed_event_lines(spark, str(tmp_path)), str(tmp_path / "turns"))) > 1


@pytest.mark.parametrize("lateness", ["0 seconds", "6 hours", "3 days"])
def test_lateness_decides_the_late_query(spark, lateness, monkeypatch):
    def other(*args, **options):
        return count_stream(*args, **{**options, "lateness": lateness})

    monkeypatch.setattr(catalog, "count_stream", other)
    sf_dir = "/root/testdata/sf0.001"
    found = catalog.QUERIES["stream_windowed_word_count_late"](spark, sf_dir)
    total = found.agg({"n": "sum"}).first()[0]
    monkeypatch.undo()
    wanted = catalog.QUERIES["stream_windowed_word_count_late"](spark, sf_dir).agg({"n": "sum"}).first()[0]
    assert (total > wanted) - (total < wanted) == {"0": -1, "6": 0, "3": 1}[lateness[0]]
