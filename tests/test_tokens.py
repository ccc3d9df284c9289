import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wordflow.operators.tokens import longest_words, words


def as_rows(df):
    return [tuple(row) for row in df.collect()]


def test_case_kept_and_separators_dropped(spark):
    df = spark.createDataFrame([(1, "  Hello, hello_World 42! ")], "id int, line string")
    assert as_rows(words(df)) == [(1, 0, "Hello"), (1, 1, "hello_World"), (1, 2, "42")]


def test_lines_without_words(spark):
    df = spark.createDataFrame([("",), ("?!..",), (None,), (" \n\t",)], "line string")
    assert as_rows(words(df)) == []
    assert as_rows(longest_words(df)) == []


def test_other_letters_break_words(spark):
    df = spark.createDataFrame([("Étre naïve",)], "line string")
    assert [row.word for row in words(df).collect()] == ["tre", "na", "ve"]


def test_other_columns_and_names(spark):
    df = spark.createDataFrame([("a b", "x", 1)], "text string, source string, id int")
    found = words(df, line="text", word="w", pos="at")
    assert found.columns == ["source", "id", "at", "w"]
    assert words(df, line="text", pos=None).columns == ["source", "id", "word"]


def test_longest_word_of_each_line(spark):
    df = spark.createDataFrame([(1, "aa bbb ccc d"), (2, "!x")], "id int, line string")
    assert sorted(as_rows(longest_words(df))) == [(1, 1, "bbb"), (2, 0, "x")]


TEXTS = st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=40), max_size=30)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(TEXTS)
def test_same_as_split_on_non_word_characters(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, line string")
    wanted = [
        (i, pos, word)
        for i, text in enumerate(texts)
        for pos, word in enumerate(w for w in re.split(r"\W+", text, flags=re.ASCII) if w)
    ]
    assert sorted(as_rows(words(df))) == wanted
    longest = {}
    for i, pos, word in wanted:
        if i not in longest or len(word) > len(longest[i][2]):
            longest[i] = (i, pos, word)
    assert sorted(as_rows(longest_words(df))) == sorted(longest.values())


@pytest.mark.parametrize("name", ["word", "pos", "POS"])
def test_names_that_are_given_out_must_be_free(spark, name):
    rows = spark.createDataFrame([("a b", 1)], f"line string, {name} int")
    for find in (words, longest_words):
        with pytest.raises(ValueError, match="rename"):
            find(rows)
    assert words(rows, word="w", pos="p").columns == [name, "p", "w"]
