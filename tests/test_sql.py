"""The jobs from SQL."""

import math

import pytest
from conftest import TOP_K_LINES, TOP_K_RESULT, plan_of

from wordflow.functions.mergeable import AVERAGE_LENGTH
from wordflow.operators.combine import combine_globally
from wordflow.operators.records import keyed_lines, to_records
from wordflow.operators.tokens import words
from wordflow.plans import words as jobs
from wordflow.sql import register_functions, register_jobs


@pytest.fixture(scope="module", autouse=True)
def functions(spark):
    register_functions(spark)
    register_functions(spark)


TEXTS = ["a b a", "", None, "..", "  Étre l'eau_1 x", "one"]


def test_words_as_a_table_function(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "id int, line string")
    frame.createOrReplaceTempView("texts")
    found = spark.sql("select id, w.* from texts, lateral words(line) w")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, words(frame).collect()))
    assert "Python" not in plan_of(found)
    assert sorted(map(tuple, spark.sql("select * from word_count('b a b')").collect())) == [("a", 1), ("b", 2)]


def test_records(spark):
    rows = [("k", "v"), (None, "v"), ("k", None), (None, None)]
    frame = spark.createDataFrame(rows, "k string, v string")
    frame.createOrReplaceTempView("records")
    got = [r[0] for r in spark.sql("select keyed_line(k, v) from records").collect()]
    assert got == [r.line for r in keyed_lines(frame.withColumnsRenamed({"k": "key", "v": "value"})).collect()]
    assert [r[0] for r in spark.sql("select value_line(v) from records").collect()] == ["v", "v", "", ""]
    numbers = spark.createDataFrame([(1, 1.5), (-7, -0.25)], "n bigint, x double")
    numbers.createOrReplaceTempView("numbers")
    got = [tuple(map(bytes, r)) for r in spark.sql("select long_bytes(n), double_bytes(x) from numbers").collect()]
    assert got == [tuple(map(bytes, r)) for r in to_records(numbers, "n", "x").collect()]


def test_the_accumulator_of_an_average(spark):
    text = "average_merge(average_add('a'), average_merge(average_add('bbb'), null))"
    assert spark.sql(f"select average_finish({text})").first()[0] == 2.0
    empty = spark.sql("select average_finish(average_merge(null, average_add(null)))").first()[0]
    assert math.isnan(empty)


@pytest.mark.parametrize("texts", [TEXTS, ["..", None], []])
def test_jobs(spark, lines, texts):
    frame = lines(*[(i, t) for i, t in enumerate(texts)]) if texts else lines((0, "a")).limit(0)
    frame.createOrReplaceTempView("job_lines")
    register_jobs(spark, "job_lines", "10 seconds", 3)

    def rows(view):
        return sorted(map(str, spark.table(view).collect()))

    def same(view, wanted):
        assert rows(view) == sorted(map(str, wanted.collect())), view

    same("word_counts", jobs.word_count(frame))
    same("windowed_word_counts", jobs.windowed_word_count(frame, "10 seconds"))
    same("top_words", jobs.top_k_words(frame, "10 seconds", 3))
    same("longest_words", jobs.longest_word(frame, ["id"]))
    same("average_word_lengths", combine_globally(words(frame, pos=None), AVERAGE_LENGTH))


def test_top_k_golden(spark, lines):
    lines(*TOP_K_LINES).createOrReplaceTempView("golden_lines")
    register_jobs(spark, "golden_lines", "10 seconds", 3)
    found = spark.sql("select * from top_words order by window_start, rank").collect()
    assert [(r.word, r.n) for r in found] == TOP_K_RESULT
