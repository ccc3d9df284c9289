from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use for results or inside.
CLASHES = ["row", "kept", "id", "key", "doc", "fp", "n_lines", "gone", "score", "ids", "counts", "made"]


def prose(seed: int, words: int, line: int = 12) -> str:
    rng = random.Random(seed)
    made = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(words)]
    return "\n".join(" ".join(made[i : i + line]) for i in range(0, words, line))


@pytest.fixture(scope="session")
def texts() -> list[tuple[int | None, str | None, str | None, str | None]]:
    """Ids, texts, languages, sources: nulls, empty and long texts, ties, repeated rows, copies."""
    plain = prose(1, 90)
    near = plain.replace(plain.split()[40], "changed", 1)
    shared = "This line stands in several documents."
    rows = [
        (1, plain, "en", "a"),
        (2, plain, "en", "a"),
        (3, near, "en", "a"),
        (4, None, "en", "b"),
        (5, "", None, "b"),
        (6, " \t\n \x0b", "de", None),
        (7, f"{shared}\n{prose(2, 40)}\n{shared}", "de", "b"),
        (8, f"{prose(3, 40)}\n  {shared.upper()}  \nend", "de", "b"),
        (None, f"{shared}\n{prose(4, 30)}", "de", "b"),
        (9, "one two", None, None),
        (9, "one two", None, None),
        (-5, "ﬁn Größe 你好 😀 ▁ é #### $$$ %%%", "fr", "c"),
        (10, prose(5, 20000), "fr", "c"),
        (11, "x" * 100_000, "fr", "c"),
        (12, prose(6, 30) + "\n" + prose(7, 60), "es", "c"),
        (13, prose(7, 60) + "\n" + prose(8, 30), "es", "c"),
        (14, "\n".join([prose(9, 8)] * 6), "es", "c"),
    ]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(*row, len(row[1] or "")) for row in texts]
    frame = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    return frame.withColumns({name: F.lit(f"own {name}") for name in CLASHES})


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
