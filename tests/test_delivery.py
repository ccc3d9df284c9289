"""Batches that run again, sends that stop in the middle, and what arrives."""

import pytest
from pyspark.sql import functions as F

from wordflow.operators.records import to_records
from wordflow.operators.stamps import judge_stamps
from wordflow.sinks.commits import KEPT, CommitLog, Versions
from wordflow.sinks.kafka import _with_headers, delivered_ids
from wordflow.sinks.outbox import DELIVERY, Outbox, append_to_table, arrived_in_table
from wordflow.sources.replay import fed_stream, put, staged_parts
from wordflow.streaming.runs import run_in_turn, running
from wordflow.streaming.stamps import committed_lines, stamp_stream


class Killed(Exception):
    pass


def batch_of(spark, n, first=0):
    return spark.range(first, first + n).selectExpr("id as place", "concat('w', id) as word", "id as n")


def outbox_to(spark, path, **target):
    folder = str(path / "delivery")
    send = target.get("send") or append_to_table(str(path / "topic"))
    return Outbox(spark, "test", folder, ["place", "word"], send, arrived_in_table(str(path / "topic")))


def arrived(spark, path):
    return sorted(r.place for r in spark.read.parquet(str(path / "topic")).collect())


def test_a_committed_batch_is_not_sent_again(spark, tmp_path):
    for _ in range(3):
        outbox_to(spark, tmp_path)(batch_of(spark, 5), 0)
    outbox_to(spark, tmp_path)(batch_of(spark, 5, 5), 1)
    assert arrived(spark, tmp_path) == list(range(10))


@pytest.mark.parametrize("share", [0, 2, 5])
def test_killed_between_send_and_commit(spark, tmp_path, share):
    """The target has none, some or all of the records when the job dies."""
    deliver = append_to_table(str(tmp_path / "topic"))

    def dying(records):
        deliver(records.filter(F.col("place") < share))
        raise Killed

    with pytest.raises(Killed):
        outbox_to(spark, tmp_path, send=dying)(batch_of(spark, 5), 0)
    with pytest.raises(Killed):
        outbox_to(spark, tmp_path, send=dying)(batch_of(spark, 5), 0)
    outbox_to(spark, tmp_path)(batch_of(spark, 5), 0)
    assert arrived(spark, tmp_path) == list(range(5))


def test_what_was_put_into_the_outbox_is_what_is_sent(spark, tmp_path):
    """A batch that comes out otherwise the second time changes nothing."""
    def dying(records):
        raise Killed

    with pytest.raises(Killed):
        outbox_to(spark, tmp_path, send=dying)(batch_of(spark, 5), 7)
    outbox_to(spark, tmp_path)(batch_of(spark, 9), 7)
    assert arrived(spark, tmp_path) == list(range(5))


def test_equal_records_of_two_batches_both_arrive(spark, tmp_path):
    outbox_to(spark, tmp_path)(batch_of(spark, 2), 0)
    outbox_to(spark, tmp_path)(batch_of(spark, 2), 1)
    assert arrived(spark, tmp_path) == [0, 0, 1, 1]
    assert spark.read.parquet(str(tmp_path / "topic")).select(DELIVERY).distinct().count() == 4


def test_an_empty_batch_is_committed(spark, tmp_path):
    outbox = outbox_to(spark, tmp_path)
    outbox(batch_of(spark, 0), 0)
    assert outbox.log.done(0) and arrived(spark, tmp_path) == []


def test_ids_travel_as_headers(spark, tmp_path):
    outbox = outbox_to(spark, tmp_path)
    sent = outbox._with_ids(batch_of(spark, 4), 3)
    messages = _with_headers(to_records(sent, "word", "n", DELIVERY))
    assert messages.columns == ["key", "value", "headers"]
    other = spark.sql("select binary('k') as key, binary('v') as value, cast(null as array<struct<key string, value binary>>) as headers")
    assert sorted(delivered_ids(messages.union(other)).collect()) == sorted(sent.select(DELIVERY).collect())


def test_versions(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "state"))
    assert versions.before(5) is None
    for n in range(5):
        versions.write(n, batch_of(spark, n))
        versions.write(n, batch_of(spark, n))
    assert versions.before(4).count() == 3 and versions.read(4).count() == 4
    assert versions._ids() == list(range(5 - KEPT, 5))
    (tmp_path / "state" / "version-4" / "_SUCCESS").unlink()
    assert not versions.has(4) and versions.before(9).count() == 3


def test_commits(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.committed() == [] and not log.done(1)
    for n in (1, 10, 2, 2):
        log.commit(n)
    assert log.committed() == [1, 2, 10] and log.done(10)


def test_staged_parts_are_read_once_and_put_once(spark, tmp_path):
    rows = batch_of(spark, 30)
    parts = staged_parts(rows, str(tmp_path / "parts"), F.col("place") % 12 - 1)
    assert [p.rpartition("=")[2] for p in parts] == [str(n) for n in range(-1, 11)]
    stream = fed_stream(spark, str(tmp_path / "in"), rows.schema)
    seen = []
    writer = stream.writeStream.foreachBatch(lambda b, n: seen.append(sorted(r.place for r in b.collect())))
    with running(spark, writer.option("checkpointLocation", str(tmp_path / "state"))) as query:
        for part in parts:
            put(spark, part, str(tmp_path / "in"))
            put(spark, part, str(tmp_path / "in"))
            query.processAllAvailable()
    assert [s for s in seen if s] == [[n for n in range(30) if n % 12 == k] for k in range(12)]


LINES = ["2024-01-02;a", "2024-01-02 03:04:05;b;c", "x;d", "no date", ";e", "02.01.2024;", "2024/01/02 00:00:00;f"]


def test_stamps_of_a_failed_batch_come_once(spark, tmp_path, monkeypatch):
    frame = spark.createDataFrame(list(enumerate(LINES)), "id int, line string")
    parts = staged_parts(frame, str(tmp_path / "parts"), F.col("id") / 3)
    feed, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        stream = fed_stream(spark, feed, frame.schema)
        run_in_turn(spark, stamp_stream(stream, out, str(tmp_path / "state")), parts, feed)

    commit, deaths = CommitLog.commit, [1]

    def dying(log, batch_id):
        if deaths:
            deaths.pop()
            raise Killed
        commit(log, batch_id)

    monkeypatch.setattr(CommitLog, "commit", dying)
    with pytest.raises(Exception, match="STREAM_FAILED"):
        run()
    # The files of the batch are there, but not committed.
    assert committed_lines(spark, out, frame.schema).count() == 0
    run()
    found = committed_lines(spark, out, frame.schema)
    judged = judge_stamps(frame)
    assert sorted((r.id, r.outcome) for r in found.collect()) == sorted((r.id, r.outcome) for r in judged.collect())
    assert sorted(r.batch_id for r in found.select("batch_id").distinct().collect())[0] >= 0
