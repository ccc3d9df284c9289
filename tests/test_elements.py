"""A result per element of a stream, over micro-batches that may run again."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wordflow.functions.mergeable import AVERAGE_LENGTH, LONGEST_WORD
from wordflow.operators.event_time import assign_event_time
from wordflow.operators.running import running_combine, total_of
from wordflow.plans.words import running_average_word_length
from wordflow.sinks.batches import batch_folders
from wordflow.sources.replay import fed_stream, staged_parts
from wordflow.streaming.elements import advance, running_elements, running_words, timed_stream
from wordflow.streaming.runs import run_in_turn, run_to_end


class Killed(Exception):
    pass


@pytest.fixture
def play(spark, tmp_path):
    """Runs a stream of the rows' parts to its end and gives all results."""

    def run(rows, part, writer):
        feed, folder = str(tmp_path / "in"), str(tmp_path)
        parts = staged_parts(rows, f"{folder}/parts", part)
        stream = fed_stream(spark, feed, rows.schema)
        run_to_end(
            stream, f"{folder}/end",
            lambda s: writer(s, batch_folders(f"{folder}/out"), f"{folder}/totals", f"{folder}/state"),
            parts=parts, feed=feed,
        )
        return spark.read.parquet(f"{folder}/out")

    return run


# Inputs and results of the two running examples, here one row per element.


@pytest.mark.parametrize("batches", [1, 2, 4])
def test_longest_word_golden(lines, play, batches):
    rows = lines((0, "a"), (10, "bb"), (20, "ccc"), (30, "d"))
    found = play(
        rows, F.col("id") * batches / 4,
        lambda s, sink, totals, state: running_words(s, LONGEST_WORD, ["ts", "id"], sink, totals, state, with_final=True),
    )
    got = found.orderBy("is_final", "ts").collect()
    assert [r.word for r in got] == ["a", "bb", "ccc", "ccc", "ccc"]
    assert [r.element for r in got] == ["a", "bb", "ccc", "d", None]
    assert [r.is_final for r in got] == [False] * 4 + [True]


@pytest.mark.parametrize("batches", [1, 3])
def test_average_golden(spark, play, batches):
    rows = spark.createDataFrame([(0, "a"), (10, "bb"), (20, "ccc")], "s bigint, word string")
    rows = rows.select(F.timestamp_seconds("s").alias("ts"), "word", "s")
    found = play(
        rows, F.col("s") * batches / 30,
        lambda s, sink, totals, state: running_elements(
            s.filter("word <> '' or word is null"), AVERAGE_LENGTH, ["ts"], sink, totals, state
        ),
    )
    got = found.filter("ts < timestamp'2000-01-01'").orderBy("ts").collect()
    assert [r.avg_len for r in got] == [1.0, 1.5, 2.0]


@pytest.mark.parametrize("with_default", [True, False])
@pytest.mark.parametrize("text", ["..", None])
def test_an_empty_stream_has_its_default_once(lines, play, with_default, text):
    found = play(
        lines((0, text), (5, ".")), F.col("id"),
        lambda s, sink, totals, state: running_words(
            s, AVERAGE_LENGTH, ["ts", "id"], sink, totals, state, with_default=with_default, with_final=True
        ),
    ).collect()
    assert [math.isnan(r.avg_len) and r.is_final for r in found] == [True] * with_default


def test_no_default_once_there_was_a_word(lines, play):
    found = play(
        lines((0, "a"), (5, "bbb")), F.col("id"),
        lambda s, sink, totals, state: running_words(s, AVERAGE_LENGTH, ["ts", "id"], sink, totals, state, with_default=True),
    )
    assert sorted(r.avg_len for r in found.collect()) == [1.0, 2.0]


def test_a_batch_that_runs_again_gives_the_same(spark, lines, tmp_path):
    """The sink fails behind the totals of a batch, and the query starts anew."""
    rows = lines((0, "a"), (10, "bb ccc"), (20, "dddd"), (30, "e"))
    feed, folder, deaths = str(tmp_path / "in"), str(tmp_path), [0, 2]
    parts = staged_parts(rows, f"{folder}/parts", F.col("id"))
    write = batch_folders(f"{folder}/out")

    def sink(results, batch_id):
        write(results, batch_id)
        if deaths and results.count():
            deaths.pop()
            raise Killed

    for _ in range(3):
        stream = fed_stream(spark, feed, rows.schema)
        writer = running_words(stream, AVERAGE_LENGTH, ["ts", "id"], sink, f"{folder}/totals", f"{folder}/state")
        try:
            run_in_turn(spark, writer, parts, feed)
        except Exception as failure:
            assert "STREAM_FAILED" in str(failure)
    found = spark.read.parquet(f"{folder}/out").orderBy("ts", "pos").collect()
    assert not deaths
    assert [r.avg_len for r in found] == [1.0, 1.5, 2.0, 2.5, 2.2]


def test_a_growing_table_pays_for_what_is_new(spark, lines, tmp_path):
    rows = lines(*[(i, f"w{'x' * (i % 7)} y") for i in range(60)])
    from wordflow.operators.tokens import words

    def expand(frame):
        return words(frame, "line", "element")

    got = []
    for n in range(3):
        path = str(tmp_path / f"part{n}")
        rows.filter(F.floor(F.col("id") / 20) == n).write.parquet(path)
        new = spark.read.parquet(path)
        for _ in range(2):
            results, _ = advance(
                new, n, str(tmp_path / "totals"), AVERAGE_LENGTH, ["ts", "id"], "element", expand, ["pos"]
            )
            found = results.collect()
        # Files of this part and the row of totals before it; of no earlier part.
        read = {f.rsplit("/", 2)[1] for f in results.inputFiles()}
        assert read == {f"part{n}"} | ({f"version-{n - 1}"} if n else set())
        got += found
    whole = running_average_word_length(rows, ["ts", "id"]).collect()
    assert sorted((r.id, r.pos, r.avg_len) for r in got) == sorted((r.id, r.pos, r.avg_len) for r in whole)


def test_totals_that_come_before(spark):
    first = spark.createDataFrame([(1, "aaaa"), (2, "b")], "s bigint, word string")
    later = spark.createDataFrame([(3, "c"), (4, "ddd")], "s bigint, word string")
    start = total_of(first, AVERAGE_LENGTH, ["s"])
    for ranges in (1, 4):
        found = running_combine(later, AVERAGE_LENGTH, ["s"], start=start, ranges=ranges, with_final=True).orderBy("is_final", "s")
        assert [round(r.avg_len, 6) for r in found.collect()] == [2.0, 2.25, 2.25]
    assert total_of(later.limit(0), AVERAGE_LENGTH, ["s"]).first() == (None, None)


BASE = datetime(2024, 1, 1)


def test_event_times_go_on_over_batches_and_restarts(spark, tmp_path):
    rows = spark.range(100).selectExpr("id * 7 as place", "concat('line ', id) as line")
    feed, folder = str(tmp_path / "in"), str(tmp_path)
    parts = staged_parts(rows, f"{folder}/parts", F.col("place") / 150)
    assert len(parts) == 5
    for some in (parts[:2], parts[2:3], parts[3:]):
        stream = fed_stream(spark, feed, rows.schema)
        writer = timed_stream(
            stream, ["place"], BASE, batch_folders(f"{folder}/out"), f"{folder}/totals", f"{folder}/state", step_ms=5
        )
        run_in_turn(spark, writer, some, feed)
    got = spark.read.parquet(f"{folder}/out").select("place", "line", "ts")
    wanted = assign_event_time(rows, ["place"], BASE, step_ms=5).select("place", "line", "ts")
    assert sorted(got.collect()) == sorted(wanted.collect())
