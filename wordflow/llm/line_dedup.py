"""Lines that several documents share stay in one of them only.

Normalised lines are exploded and hashed, documents are counted per hash, and
each document is put together again from the lines it keeps, by position.
"""

from __future__ import annotations

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordflow.llm.common import BLANKS, UPPER, packed, unpacked, written

MIN_CHARS = 10
MIN_DOCUMENTS = 2

# Seed of Spark's xxhash64.
SEED = 42
_BLANK_BYTES = BLANKS.encode()


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lowered."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, UPPER.lower())


def _shared_lines(docs: DataFrame, id_column: str, text_column: str, min_chars: int, min_docs: int) -> DataFrame:
    """``id, gone``: first hashes of the lines each document loses. Both hashes decide what is shared."""
    key = F.col("key")
    held = (
        docs.filter(F.col(f"`{id_column}`").isNotNull())
        .select(
            F.col(f"`{id_column}`").alias("id"),
            F.explode(F.split(F.col(f"`{text_column}`"), "\n", -1)).alias("line"),
        )
        .select("id", line_key(F.col("line")).alias("key"))
        .filter(F.length(key) >= min_chars)
        .select("id", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2"))
        .distinct()
    )
    # Both sides of the join are stored, so that it is one of two plain shuffles and Spark
    # can split a line that very many documents hold.
    held = written(held, "lines")
    counted = held.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    shared = counted.filter(F.col("n") >= min_docs).select("h1", "h2", "first")
    repeated = written(shared, "shared-lines")
    lost = held.join(repeated, ["h1", "h2"]).filter(F.col("id") != F.col("first"))
    return lost.groupBy("id").agg(F.collect_list("h1").alias("gone"))


def _kept(text: str | None, gone, min_chars: int) -> tuple[str, int, int]:
    lines = (text or "").split("\n")
    if gone is None:
        return text or "", len(lines), 0
    lost = {int(h) & 0xFFFFFFFFFFFFFFFF for h in gone}
    stay = []
    for line in lines:
        key = line.encode().strip(_BLANK_BYTES).lower()
        long_enough = len(key) >= min_chars and len(key.decode()) >= min_chars
        if not (long_enough and xxhash.xxh64_intdigest(key, seed=SEED) in lost):
            stay.append(line)
    return "\n".join(stay), len(lines), len(lines) - len(stay)


def _reassemble(min_chars: int):
    @F.pandas_udf("kept string, n_lines bigint, n_dropped bigint")
    def reassemble(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
        rows = [_kept(text, lost, min_chars) for text, lost in zip(texts, gone, strict=True)]
        return pd.DataFrame(rows, columns=["kept", "n_lines", "n_dropped"])

    return reassemble


def line_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCUMENTS,
) -> DataFrame:
    """The documents with shared lines taken out, and ``n_lines``, ``n_dropped``.

    A line's key is the line without blanks at its ends and with A-Z lowered. A
    key of ``min_chars`` code points or more that at least ``min_docs`` documents
    hold loses all its lines but those in the smallest id that holds it; lines
    that repeat inside that document stay there. Other lines keep their order.

    A null or empty text is one empty line and comes back empty. Rows without an
    id hold nothing and lose nothing. Rows that share an id count as one document
    and each lose the same lines. Input columns named ``n_lines`` or ``n_dropped``
    are replaced. An empty table gives an empty table.
    """
    gone = _shared_lines(docs, id_column, text_column, min_chars, min_docs)
    joined = docs.select(packed(docs)).join(gone, F.col(f"row.`{id_column}`") == F.col("id"), "left")
    lines = _reassemble(min_chars)(F.col(f"row.`{text_column}`"), F.col("gone"))
    made = joined.select("row", lines.alias("made")).select(
        F.col("row").withField(f"`{text_column}`", F.col("made.kept")).alias("row"),
        "made.n_lines",
        "made.n_dropped",
    )
    return made.select(unpacked(docs.columns, ["n_lines", "n_dropped"]))
