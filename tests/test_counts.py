from collections import Counter
from datetime import datetime

from conftest import TOP_K_LINES, TOP_K_RESULT, plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wordflow.operators.counts import top_k
from wordflow.plans.words import top_k_words, windowed_word_count, word_count


def test_word_count_keeps_case(spark):
    df = spark.createDataFrame([("In in in",), ("In, non",)], "line string")
    assert sorted(map(tuple, word_count(df).collect())) == [("In", 2), ("in", 2), ("non", 1)]


def test_top_k_golden(lines):
    top = top_k_words(lines(*TOP_K_LINES), "10 seconds", 3)
    rows = top.orderBy("window_start", "rank").collect()
    assert [(row.word, row.n) for row in rows] == TOP_K_RESULT
    assert [row["rank"] for row in rows] == [1, 2, 3, 1, 2, 3]
    assert rows[0].window_start == datetime(2024, 1, 1)
    assert rows[0].window_end == datetime(2024, 1, 1, 0, 0, 10)


def test_row_on_a_window_boundary_opens_the_next(lines):
    found = windowed_word_count(lines((2.999, "a"), (3, "a"), (3.001, "a"), (6, "a")))
    assert [row.n for row in found.orderBy("window_start").collect()] == [1, 2, 1]


def test_windows_align_to_the_epoch(lines):
    found = windowed_word_count(lines((5, "a")), "7 seconds")
    assert found.first().window_start == datetime(2024, 1, 1, 0, 0, 4)


def test_empty_windows_have_no_rows(lines):
    assert top_k_words(lines((0, "..."), (100, None)), "10 seconds", 3).count() == 0


def test_fewer_words_than_k(lines):
    top = top_k_words(lines((0, "b a a")), "10 seconds", 5)
    assert [(r.word, r.n) for r in top.orderBy("rank").collect()] == [("a", 2), ("b", 1)]


def test_tasks_keep_k_rows_before_the_shuffle(lines):
    plan = plan_of(top_k_words(lines(*TOP_K_LINES), "10 seconds", 3))
    # Before and after the shuffle into slices, and again into windows.
    assert plan.count("WindowGroupLimit") == 4
    assert "SinglePartition" not in plan


def test_large_k_is_thinned_in_slices_and_exact(spark):
    counted = spark.range(5000).selectExpr("'g' as g", "string(id) as word", "id % 97 as n")
    wanted = [row.word for row in counted.orderBy("n", "word", ascending=[False, True]).take(1200)]
    found = top_k(counted, 1200, "g")
    assert found.columns == ["g", "word", "n", "rank"]
    assert [row.word for row in found.orderBy("rank").collect()] == wanted
    small = top_k(counted, 7, "g")
    assert [row.word for row in small.orderBy("rank").collect()] == wanted[:7]
    # One plan for all k. The only group is a constant, so the last step has no limits of its own.
    assert plan_of(small).count("WindowGroupLimit") == plan_of(found).count("WindowGroupLimit") == 2
    assert operators(found) == operators(small)
    assert "SPARK_PARTITION_ID" not in plan_of(found)


def operators(df):
    """Names without their arguments, which hold the limit."""
    lines = (line.strip(" +-:*()0123456789") for line in plan_of(df).splitlines())
    return [line.split()[0].partition("(")[0] for line in lines if line]


def test_columns_may_be_called_slice_and_rank_is_replaced(spark):
    rows = [("a", 3, 1), ("b", 2, 1), ("c", 1, 1)]
    counted = spark.createDataFrame(rows, "word string, n int, slice int")
    assert sorted(row.word for row in top_k(counted, 2, "slice").collect()) == ["a", "b"]


TIMED = st.lists(
    st.tuples(st.integers(0, 29), st.text(alphabet="ab ", max_size=9)), min_size=1, max_size=30
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(TIMED, st.integers(1, 4))
def test_same_as_counting_by_hand(lines, pairs, k):
    by_window = {}
    for second, text in pairs:
        by_window.setdefault(second // 10, Counter()).update(text.split())
    wanted = [
        (10 * window, *item)
        for window, counter in sorted(by_window.items())
        for item in sorted(counter.items(), key=lambda item: (-item[1], item[0]))[:k]
    ]
    top = top_k_words(lines(*pairs), "10 seconds", k).orderBy("window_start", "rank").collect()
    assert [(row.window_start.second, row.word, row.n) for row in top] == wanted
