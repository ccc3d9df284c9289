"""The topic jobs without a broker: a table stands in for the input topic."""

import struct

import pytest

from wordflow.functions.mergeable import AVERAGE_LENGTH
from wordflow.operators.records import keyed_lines, to_records, with_key
from wordflow.operators.tokens import words
from wordflow.plans import topics
from wordflow.sources.kafka import KAFKA_SCHEMA, text_records
from wordflow.streaming.running import combine_so_far
from wordflow.streaming.runs import run_available


@pytest.fixture
def topic(spark, tmp_path):
    """Two records, as a stream in the connector's shape."""
    spark.sql(
        "select cast(null as binary) as key, binary('the first') as value, 't' as topic, 0 as partition,"
        " 1L as offset, timestamp'2024-01-01 00:00:01' as timestamp, 0 as timestampType"
        " union all select binary('key'), binary('the'), 't', 0, 2L,"
        " timestamp'2024-01-01 00:00:02', 0"
    ).coalesce(1).write.parquet(str(tmp_path / "topic"))
    return spark.readStream.schema(KAFKA_SCHEMA).parquet(str(tmp_path / "topic"))


def test_top_k_topic(spark, topic, tmp_path, monkeypatch):
    sent = []

    def send(top, servers, name, key, value, with_ids):
        assert with_ids
        sent.extend((bytes(r.key), bytes(r.value), name) for r in to_records(top, key, value).collect())

    closing = spark.sql(
        "select cast(null as binary) as key, binary('x') as value, 't' as topic, 0 as partition,"
        " 3L as offset, timestamp'2024-01-02' as timestamp, 0 as timestampType"
    )
    closing.write.mode("append").parquet(str(tmp_path / "topic"))
    monkeypatch.setattr(topics, "kafka_records", lambda *args: text_records(topic))
    monkeypatch.setattr(topics, "write_records", send)
    writer = topics.top_k_words_topic(
        spark, "host:9092", "in", "out", str(tmp_path / "state"), size="10 seconds", k=2
    )
    run_available(spark, writer)
    assert sorted(sent) == [
        (b"first", struct.pack(">q", 1), "out"),
        (b"the", struct.pack(">q", 2), "out"),
    ]


def test_average_records(spark, topic, tmp_path):
    so_far = combine_so_far(words(keyed_lines(text_records(topic)), pos=None), AVERAGE_LENGTH)
    sent = []

    def keep(batch, batch_id):
        sent.extend((bytes(row.key), bytes(row.value)) for row in batch.collect())

    writer = (
        to_records(with_key(so_far), value="avg_len")
        .writeStream.outputMode("update")
        .foreachBatch(keep)
        .option("checkpointLocation", str(tmp_path / "state"))
    )
    run_available(spark, writer)
    assert sent == [(b"", struct.pack(">d", 14 / 4))]


@pytest.mark.parametrize("job", [topics.longest_word_topic, topics.average_word_length_topic])
def test_running_topics_make_a_writer(spark, topic, tmp_path, monkeypatch, job):
    monkeypatch.setattr(topics, "kafka_records", lambda *args: text_records(topic))
    writer = job(spark, "host:9092", "in", "out", str(tmp_path / "state"))
    with pytest.raises(Exception, match="kafka"):
        writer.start()
