import os
import subprocess
import sys
import time

import pytest
from conftest import plan_of
from pyspark.errors import AnalysisException

from wordflow.operators.tokens import words
from wordflow.plans.words import word_count
from wordflow.session import shared_base, shared_folder
from wordflow.sinks.prints import print_stream
from wordflow.sources.kafka import kafka_records
from wordflow.sources.replay import paced_lines, replay_table
from wordflow.sources.tables import INPUT_TASKS, spread
from wordflow.sources.text import (
    PINNED,
    lines_from,
    numbered_text_lines,
    placed_text_lines,
    stream_text_lines,
    text_lines,
    without_skipped,
)
from wordflow.streaming.runs import run_available


def test_text_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("Étre in\n\nin non\n", encoding="utf-8")
    lines = text_lines(spark, str(tmp_path))
    assert [row.line for row in lines.collect()] == ["Étre in", "", "in non"]
    assert sorted(map(tuple, word_count(lines).collect())) == [("in", 2), ("non", 1), ("tre", 1)]


def test_lines_from_memory(spark):
    lines = lines_from(spark, ["b", "a"])
    assert [tuple(row) for row in lines.collect()] == [("b", 0), ("a", 1)]


def test_skipped_lines(spark):
    lines = lines_from(spark, ["a", "", " *", "*", "  ", " * "])
    assert [row.line for row in without_skipped(lines).collect()] == ["a", "*", "  ", " * "]


def stream_rows(spark, df, folder):
    batches = {}

    def keep(batch, batch_id):
        batches[batch_id] = [row.line for row in batch.collect()]

    writer = df.writeStream.foreachBatch(keep).option("checkpointLocation", str(folder))
    run_available(spark, writer)
    return [batches[i] for i in sorted(batches)]


def write_in_order(folder, texts):
    folder.mkdir()
    for i, text in enumerate(texts):
        path = folder / f"{i}.txt"
        path.write_text(text)
        at = time.time() - 1000 + i
        os.utime(path, (at, at))


def test_paced_lines_come_file_by_file(spark, tmp_path):
    write_in_order(tmp_path / "in", ["a\n *\nb\n", "\n\n", "c\n"])
    paced = paced_lines(spark, str(tmp_path / "in"))
    assert stream_rows(spark, paced, tmp_path / "state") == [["a", "b"], [], ["c"]]


def test_stream_of_text_takes_all_there_is(spark, tmp_path):
    write_in_order(tmp_path / "in", ["a\n", "b\n"])
    rows = stream_rows(spark, stream_text_lines(spark, str(tmp_path / "in")), tmp_path / "state")
    assert [sorted(batch) for batch in rows] == [["a", "b"]]


def test_spread_only_where_the_session_asks(spark):
    few = spark.range(0, 100, 1, 1)
    assert spread(few) is few
    assert "Exchange" not in plan_of(words(spread(few).selectExpr("string(id) as line")))
    spark.conf.set(INPUT_TASKS, "3")
    try:
        assert spread(few).rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset(INPUT_TASKS)


@pytest.mark.parametrize("files", [1, 3])
@pytest.mark.parametrize("folder", [True, False])
def test_a_table_is_replayed_as_file_or_folder(spark, tmp_path, files, folder):
    rows = spark.range(0, 60, 1, files).selectExpr("id", "string(id) as line")
    path = str(tmp_path / "events.parquet")
    rows.write.parquet(path)
    if not folder:
        parts = sorted((tmp_path / "events.parquet").glob("part-*"))
        (tmp_path / "single").mkdir()
        parts[0].rename(tmp_path / "single" / "events.parquet")
        path = str(tmp_path / "single" / "events.parquet")
    batches = stream_batches(spark, replay_table(spark, path, files_per_trigger=1), tmp_path / "state")
    assert sorted(r for b in batches for r in b) == sorted(r.id for r in spark.read.parquet(path).collect())
    assert sum(map(bool, batches)) == (files if folder else 1)


def stream_batches(spark, stream, state):
    found = []
    writer = stream.writeStream.foreachBatch(lambda b, _: found.append([r.id for r in b.collect()]))
    run_available(spark, writer.option("checkpointLocation", str(state)))
    return found


def test_lines_are_placed_without_moving_them(spark, tmp_path):
    write_in_order(tmp_path / "in", ["a\nb\n", "c\n", "d\ne\nf\n"])
    placed = placed_text_lines(spark, str(tmp_path / "in"))
    rows = placed.orderBy("place").collect()
    assert [r.place for r in rows] == list(range(6))
    order = "".join(r.line for r in rows)
    assert all(run in order for run in ("ab", "c", "def"))
    plan = plan_of(placed)
    # What is exchanged is the counts per split and their sums.
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan


def test_numbers_need_pinned_splits(spark, tmp_path):
    pinned = spark.conf.get(PINNED)
    spark.conf.unset(PINNED)
    try:
        with pytest.raises(ValueError, match="minPartitionNum"):
            numbered_text_lines(spark, str(tmp_path))
        assert spark.conf.get(PINNED, None) is None
    finally:
        spark.conf.set(PINNED, pinned)


def test_shared_folder_is_new_each_time(spark):
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one != two and one.rpartition("/x-")[0] == two.rpartition("/x-")[0]
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert not base or one.startswith(f"{base.rstrip('/')}/wordflow-")


def test_shared_folders_go_with_the_application(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    settings = {"spark.master": "local[1]", "spark.ui.enabled": "false", "spark.checkpoint.dir": f"file://{tmp_path}"}
    code = SCRATCH.format(root=root, settings=settings)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == ["wordflow", "3"]
    assert list(tmp_path.glob("wordflow-*")) == []


SCRATCH = """
import os, sys
sys.path.insert(0, {root!r})
from wordflow.session import build_session, shared_folder
spark = build_session("scratch", {settings!r})
spark.range(3).write.parquet(folder := shared_folder(spark, "x"))
print(folder.split("/")[-2].split("-")[0], spark.read.parquet(folder).count())
spark.stop()
"""


class WithoutFolder:
    """A session in which ``spark.checkpoint.dir`` is not set."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = type("Context", (), {"master": master})


def test_only_local_sessions_do_without_a_shared_folder():
    assert os.path.isdir(shared_base(WithoutFolder("local[2]")))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_base(WithoutFolder("spark://host:7077"))


def test_kafka_needs_its_package(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        kafka_records(spark, "host:9092", "topic", stream=False)


PRINTING = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from wordflow.sinks.prints import print_elements
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
print_elements(spark.createDataFrame([("w", 41), ("v", 42)], "word string, n bigint"))
"""


def test_prints_go_to_standard_error():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-c", PRINTING.format(root=root)],
        capture_output=True, text=True, timeout=120,
    )
    assert "w 41" in done.stderr and "v 42" in done.stderr


def test_stream_prints(spark, tmp_path):
    write_in_order(tmp_path / "in", ["a\n"])
    lines = stream_text_lines(spark, str(tmp_path / "in"))
    writer = print_stream(lines).option("checkpointLocation", str(tmp_path / "state"))
    run_available(spark, writer)
