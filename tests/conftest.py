from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wordflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        {
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """Builds ``ts, id, line`` from (seconds after the base, text) pairs, ids in their order."""

    def build(*pairs, base="2024-01-01 00:00:00"):
        rows = [(i, float(seconds), text) for i, (seconds, text) in enumerate(pairs)]
        frame = spark.createDataFrame(rows, "id bigint, s double, line string")
        return frame.selectExpr(
            f"timestamp_micros(unix_micros(timestamp'{base}') + bigint(s * 1000000)) as ts",
            "id",
            "line",
        )

    return build


# The lines (seconds, text) and result of the top-k example, k = 3, 10 s windows.
TOP_K_LINES = (
    (0, "This is the first line."),
    (1, "This is the second line in the first window"),
    (2, "Last line in the first window"),
    (10, "This is another line, but in different window."),
    (11, "Last line, in the same window as previous line"),
)

TOP_K_RESULT = [("the", 4), ("first", 3), ("line", 3), ("line", 3), ("in", 2), ("window", 2)]


def plan_of(df) -> str:
    """The physical plan, as text."""
    return df._jdf.queryExecution().executedPlan().toString()
