from itertools import accumulate

import pytest
from conftest import plan_of

from wordflow.functions.mergeable import AVERAGE_LENGTH
from wordflow.operators.running import running_combine
from wordflow.plans.words import running_average_word_length, running_longest_word


# Inputs and results of the two running examples.


def test_average_golden(spark):
    rows = [(0, "a"), (10, "bb"), (20, "ccc")]
    df = spark.createDataFrame(rows, "s bigint, word string")
    found = running_combine(df, AVERAGE_LENGTH, ["s"]).orderBy("s").collect()
    assert [row.avg_len for row in found] == [1.0, 1.5, 2.0]


def test_longest_golden(lines):
    df = lines((0, "a"), (10, "bb"), (20, "ccc"), (30, "d"))
    found = running_longest_word(df, ["ts", "id"]).orderBy("is_final", "id").collect()
    assert [row.word for row in found] == ["a", "bb", "ccc", "ccc", "ccc"]
    assert [row.is_final for row in found] == [False] * 4 + [True]
    assert found[-1].element is None


def test_nothing_gives_nothing(lines):
    assert running_longest_word(lines((0, "..")), ["ts", "id"]).count() == 0
    assert running_longest_word(lines((0, "a")).limit(0), ["ts", "id"]).count() == 0


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the lines at one time; words of many lengths; some empty lines."""
    return spark.range(3000).selectExpr(
        "if(id % 3 = 0, 1000L, pmod(id * 7919, 2000)) as t",
        "pmod(id * 31, 3000) as id",
        "if(id % 11 = 0, '', concat(repeat('w', int(id * 13 % 29)), ' x ', repeat('y', int(id % 41))))"
        " as line",
    )


def brute_force(skewed):
    words = [
        (row.t, row.id, word)
        for row in sorted(skewed.collect(), key=lambda row: (row.t, row.id))
        for word in row.line.split()
    ]
    lengths = list(accumulate(len(word) for *_, word in words))
    averages = [total / (i + 1) for i, total in enumerate(lengths)]
    longest = list(accumulate((w for *_, w in words), lambda a, b: b if len(b) > len(a) else a))
    return averages, longest


@pytest.mark.parametrize("ranges", [1, 2, 7, 64])
def test_same_results_for_any_number_of_ranges(skewed, ranges):
    averages, longest = brute_force(skewed)
    order = ["t", "id"]
    found = running_average_word_length(skewed, order, ranges=ranges).orderBy("t", "id", "pos")
    assert [row.avg_len for row in found.collect()] == averages
    found = running_longest_word(skewed, order, ranges=ranges, with_final=False)
    assert [row.word for row in found.orderBy("t", "id", "pos").collect()] == longest


def test_same_results_with_a_shuffled_join(spark, skewed):
    averages, _ = brute_force(skewed)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = running_average_word_length(skewed, ["t", "id"], ranges=5)
        plan = plan_of(found)
        assert [row.avg_len for row in found.orderBy("t", "id", "pos").collect()] == averages
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    # The lines move once, before they are words, and the range totals come to them.
    assert plan.count("REPARTITION_BY_NUM") == 2
    assert plan.count("Exchange ") == 4


def test_hot_time_is_spread_over_tasks(skewed):
    placed = running_average_word_length(skewed, ["t", "id"], ranges=8)
    per_task = placed.groupBy("t").count()  # results are whole
    assert per_task.agg({"count": "sum"}).first()[0] == placed.count()
    sizes = placed.rdd.glom().map(len).collect()
    assert max(sizes) < sum(sizes) / 3


def test_words_are_not_brought_to_one_task(skewed):
    plan = plan_of(running_average_word_length(skewed, ["t", "id"], ranges=8))
    before_window, after = plan.split("BroadcastExchange")
    assert "SinglePartition" not in before_window
    assert before_window.count("Exchange") == 1
    assert after.count("SinglePartition") == 1


def test_final_result_has_no_element(skewed):
    averages, _ = brute_force(skewed)
    final = running_average_word_length(skewed, ["t", "id"], with_final=True).filter("is_final")
    assert [(row.id, row.element, row.avg_len) for row in final.collect()] == [
        (None, None, averages[-1])
    ]
