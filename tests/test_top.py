"""The top k over all windows so far, from accumulators of k entries."""

import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wordflow.functions.top import TopEntries
from wordflow.operators.top import ENTRY, best_entries, entries_of, running_top_k
from wordflow.sinks.batches import batch_folders
from wordflow.sources.replay import fed_stream, staged_parts
from wordflow.streaming.runs import run_to_end
from wordflow.streaming.top import top_k_so_far_stream

ENTRIES = st.lists(st.tuples(st.integers(-9, 0), st.sampled_from("abc"), st.integers(0, 5)))


@given(ENTRIES, ENTRIES, st.integers(1, 6))
def test_added_and_merged(one, two, k):
    a, b = TopEntries(k), TopEntries(k)
    for entry in one:
        a.add(entry)
    for entry in two:
        b.add(entry)
    assert len(a.entries) <= k
    a.merge(b.entries)
    assert a.entries == sorted(one + two)[:k]


def made(spark, seed=1, windows=40, kind="timestamp"):
    rng = random.Random(seed)
    rows = [(w, f"w{rng.randrange(30)}{i}", rng.randrange(1, 6)) for w in range(windows) if w % 5 for i in range(rng.randrange(12))]
    frame = spark.createDataFrame(rows, "w bigint, word string, n bigint")
    start = F.timestamp_seconds(F.col("w") * 10)
    return rows, frame.select(
        start.cast(kind).alias("window_start"), (start + F.expr("interval 10 seconds")).cast(kind).alias("window_end"), "word", "n"
    )


def brute(rows, k):
    found = []
    for w in sorted({r[0] for r in rows}):
        best = sorted((-n, word, at) for at, word, n in rows if at <= w)[:k]
        found += [(w * 10, i + 1, word, -n, at * 10) for i, (n, word, at) in enumerate(best)]
    return found


def got(frame):
    return sorted((r.s, r["rank"], r.word, r.n, r.f) for r in frame.selectExpr(
        "unix_seconds(cast(window_start as timestamp)) as s", "rank", "word", "n", "unix_seconds(cast(found_at as timestamp)) as f"
    ).collect())


@pytest.mark.parametrize("k", [1, 3, 50])
@pytest.mark.parametrize("ranges", [1, 4, 16])
def test_top_k_so_far(spark, k, ranges):
    rows, counts = made(spark)
    assert got(running_top_k(counts, k, ranges=ranges)) == brute(rows, k)


def test_times_without_a_zone(spark):
    rows, counts = made(spark, kind="timestamp_ntz")
    found = running_top_k(counts, 2)
    assert dict(found.dtypes)["window_start"] == dict(found.dtypes)["found_at"] == "timestamp_ntz"
    assert got(found) == brute(rows, 2)


def test_entries_that_come_before(spark):
    rows, counts = made(spark)
    early = counts.filter("unix_seconds(window_start) < 200")
    start = best_entries(entries_of(early, 4), 4).select(*ENTRY)
    assert start.count() == 4
    late = counts.filter("unix_seconds(window_start) >= 200")
    for ranges in (1, 5):
        assert got(running_top_k(late, 4, start=start, ranges=ranges)) == [r for r in brute(rows, 4) if r[0] >= 200]
    assert running_top_k(late.limit(0), 4, start=start).count() == 0


def test_nulls_and_nothing(spark):
    _, counts = made(spark)
    nulls = counts.withColumn("word", F.lit(None).cast("string"))
    assert running_top_k(nulls, 3).count() == running_top_k(counts.limit(0), 3).count() == 0


def test_from_a_stream(spark, lines, tmp_path):
    rng = random.Random(4)
    rows = lines(*[(i * 3, " ".join(rng.choices("abcdefg", k=rng.randrange(6)))) for i in range(60)])
    folder, feed = str(tmp_path), str(tmp_path / "in")
    parts = staged_parts(rows, f"{folder}/parts", F.col("id") / 17)
    stream = fed_stream(spark, feed, rows.schema)
    run_to_end(
        stream, f"{folder}/end",
        lambda s: top_k_so_far_stream(s, "10 seconds", 3, batch_folders(f"{folder}/out"), f"{folder}/entries", f"{folder}/state"),
        parts=parts, feed=feed,
    )
    from wordflow.plans.words import windowed_word_count

    wanted = running_top_k(windowed_word_count(rows, "10 seconds"), 3)
    assert got(spark.read.parquet(f"{folder}/out")) == got(wanted)
    # What goes on from batch to batch are k entries.
    states = [p for p in (tmp_path / "entries").iterdir()]
    assert states and all(spark.read.parquet(str(p)).count() <= 3 for p in states)
