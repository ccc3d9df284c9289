import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from wordflow.operators.stamps import (
    DATE_FORMATS,
    _shape,
    judge_stamps,
    normalise_stamps,
    write_stamps,
)


@pytest.fixture
def judged(spark):
    def run(*texts, **options):
        df = spark.createDataFrame(list(enumerate(texts)), "id int, line string")
        accepted, rejected = normalise_stamps(df, **options)
        assert accepted.columns == ["id", "stamp", "rest"]
        assert rejected.columns == ["id", "line", "reason"]
        return (
            {row.id: (row.stamp, row.rest) for row in accepted.collect()},
            {row.id: (row.line, row.reason) for row in rejected.collect()},
        )

    return run


def test_accepted(judged):
    accepted, rejected = judged(
        "2021-03-04 05:06:07;a", "2021-03-04;a;b", "04.03.2021; c ", " 2021/03/04 05:06:07;;"
    )
    assert rejected == {}
    assert accepted == {
        0: ("2021-03-04T05:06:07+00:00", "a"),
        1: ("2021-03-04T00:00:00+00:00", "a;b"),
        2: ("2021-03-04T00:00:00+00:00", " c"),
        3: ("2021-03-04T05:06:07+00:00", ";"),
    }


def test_rejected(judged):
    accepted, rejected = judged("", "no", ";rest", "2021-03-04;", "2021-13-04;x", "soon;x", None)
    assert accepted == {}
    missing, unparsable = "missing_semicolon", "unparsable_date"
    assert rejected == {
        0: ("", missing), 1: ("no", missing), 2: (";rest", missing), 3: ("2021-03-04;", missing),
        4: ("2021-13-04;x", unparsable), 5: ("soon;x", unparsable), 6: (None, missing),
    }


def test_own_formats_in_their_order(judged):
    accepted, _ = judged("01/02/2021;x", "5 Mar 2021;y", formats=["dd/MM/yyyy", "MM/dd/yyyy", "d MMM yyyy"])
    assert accepted == {
        0: ("2021-02-01T00:00:00+00:00", "x"),
        1: ("2021-03-05T00:00:00+00:00", "y"),
    }


def test_own_output_is_read_again(judged):
    accepted, _ = judged("2021-03-04T05:06:07+02:00;x", "2021-03-04T05:06:07;y", "\t2021-03-04;z")
    assert accepted == {
        0: ("2021-03-04T03:06:07+00:00", "x"),
        1: ("2021-03-04T05:06:07+00:00", "y"),
        2: ("2021-03-04T00:00:00+00:00", "z"),
    }


def test_shapes():
    assert _shape("d MMM yyyy") is None
    assert _shape("[HH]") is None
    assert _shape("HH:mm") == r"^\d{2}:\d{2}$"
    assert _shape("d'T'H") == r"^[+-]?\d+T[+-]?\d+$"


def test_no_date_is_lost_to_its_shape(spark):
    """Each format reads what it writes, whether or not it has a shape."""
    times = spark.sql("select timestamp'2021-03-04 05:06:07' as t union all select timestamp'0999-12-31 23:00:01'")
    for each in (*DATE_FORMATS, "d.M.yyyy H:m:s", "yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd HH:mm:ssXXX"):
        texts = times.select(F.concat(F.date_format("t", each), F.lit(";x")).alias("line"))
        accepted, _ = normalise_stamps(texts, formats=[each])
        assert accepted.count() == 2, each


def test_both_outputs_in_one_pass(spark, tmp_path):
    frame = spark.createDataFrame(
        [(1, "2024-01-02;a;b"), (2, "no date"), (3, "soon;x"), (4, "2024-01-02;")], "id int, line string"
    )
    judged = judge_stamps(frame)
    assert judged.columns == ["id", "line", "date", "rest", "stamp", "outcome"]
    write_stamps(judged, str(tmp_path / "out"))
    rows = {(r.id, r.outcome, r.line) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows == {
        (1, "accepted", "2024-01-02T00:00:00+00:00;a;b"),
        (2, "missing_semicolon", "no date"),
        (3, "unparsable_date", "soon;x"),
        (4, "missing_semicolon", "2024-01-02;"),
    }
    assert plan_of(judged).count("Scan") == 1
