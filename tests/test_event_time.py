from datetime import datetime, timedelta, timezone

from wordflow.operators.event_time import assign_event_time
from wordflow.plans.words import windowed_word_count
from wordflow.sources.text import numbered_text_lines

BASE = datetime(2024, 5, 1, 12)


def test_times_follow_the_order(spark):
    df = spark.range(1000).selectExpr("pmod(id * 17, 1000) * 3 as id", "'x' as other")
    timed = assign_event_time(df, ["id"], BASE, step_ms=5, ranges=6).orderBy("id").collect()
    assert [row.ts for row in timed] == [BASE + timedelta(milliseconds=5 * i) for i in range(1000)]
    assert timed[0].other == "x"


def test_base_with_a_time_zone(spark):
    base = datetime(2024, 5, 1, 14, tzinfo=timezone(timedelta(hours=2)))
    assert assign_event_time(spark.range(1), ["id"], base).first().ts == BASE


def test_lines_of_a_file_in_windows(spark, tmp_path):
    """One line per millisecond: the whole of a small file is one window."""
    (tmp_path / "a.txt").write_text("".join(f"line {i % 2}\n" for i in range(500)))
    lines = numbered_text_lines(spark, str(tmp_path))
    counts = windowed_word_count(assign_event_time(lines, ["line_no"], BASE)).collect()
    assert sorted((row.word, row.n) for row in counts) == [("0", 250), ("1", 250), ("line", 500)]
    assert {row.window_start for row in counts} == {BASE}


def test_line_numbers_rise_along_a_split_file(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"{i:06d}\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        lines = numbered_text_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 3
        rows = lines.orderBy("line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [row.line for row in rows] == [f"{i:06d}" for i in range(20_000)]
