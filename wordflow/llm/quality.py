"""Quality rules whose limits follow each language and source.

Every measure of a document falls into a bucket of a quantile sketch: its value
with all but the six leading bits cleared, so a bucket is at most 1/32 wide. A
sketch is a count per bucket. Counts add up, so sketches merge: map-side, across
tasks, and from source to language to the whole. Each source's sketch gets a fixed
number of documents from its language's, and that one from the sketch of all, at
every size, so that a source that grows goes over to its own limits little by
little. A limit is read off a sketch as quartile and a multiple of the quartile
distance, and joined back to the documents of its group.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordflow.llm.common import BLANKS, packed, unpacked, words_of, written

# Fixed values of the base rule.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
RESULTS = [*COUNTS[:5], "base_failed", "kept"]
LEADING_BITS = 6


@dataclass(frozen=True)
class Fence:
    """Limits ``reach`` quartile distances, but at least ``slack``, outside the quartiles."""

    slack: int
    reach: int = 3
    low: bool = False


#: Per measure, all in whole hundredths or thousandths so that every engine agrees on them.
FENCES = {
    "word_length": Fence(slack=200, low=True),  # hundredths of a character
    "symbol_rate": Fence(slack=50),  # per thousand words
    "dup_line_rate": Fence(slack=500),  # per thousand lines
}
#: Documents that a source's sketch gets from its language's, and that one from the sketch of all.
BACKOFF = 50
# Parts of a group in the join with its limits, so that a hot source is spread.
SALTS = 64


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that are found twice or more, the first ones included. Exact."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ranks = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    # Ranks of windows of one word, then 2, 4, ... words: equal ranks are equal windows.
    width = 1
    while width < window:
        step = min(width, window - width)
        pairs = ranks[:-step] * (int(ranks.max()) + 1) + ranks[step:]
        _, ranks, sizes = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(sizes) == len(ranks):
            return 0
        width += step
    edges = np.zeros(len(words) + 1, np.int64)
    twice = np.flatnonzero(sizes[ranks] > 1)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def counts_of(text: str | None) -> tuple[int, ...]:
    """The values of ``COUNTS``; all zero for null."""
    if text is None:
        return (0,) * len(COUNTS)
    words = words_of(text)
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.encode().split(b"\n") if line.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines)


def text_counts(text: Column) -> Column:
    """The values of ``COUNTS`` as a struct."""

    @F.pandas_udf(", ".join(f"{c} bigint" for c in COUNTS))
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([counts_of(t) for t in texts], columns=COUNTS, dtype="int64")

    return of(text)


def _rate(part: str, whole: str, scale: int) -> Column:
    return F.expr(f"coalesce(({scale} * counts.{part}) div nullif(counts.{whole}, 0), 0)")


def _measured(docs: DataFrame, carried: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    counted = docs.select(
        packed(carried),
        F.col(f"`{lang}`").alias("lang"),
        F.col(f"`{source}`").alias("source"),
        text_counts(F.col(f"`{text}`")).alias("counts"),
    )
    too_short = F.col("counts.n_words") < MIN_WORDS
    repeats = 100 * F.col("counts.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("counts.n_words")
    return counted.select(
        "*",
        (too_short | repeats).alias("base_failed"),
        _rate("word_chars", "n_words", 100).alias("word_length"),
        _rate("n_symbols", "n_words", 1000).alias("symbol_rate"),
        _rate("n_dup_lines", "n_lines", 1000).alias("dup_line_rate"),
    )


def bucket(value: Column) -> Column:
    """The value with all but its leading bits cleared: the least value of its bucket."""
    return F.call_function("shiftleft", F.call_function("shiftright", value, _spare(value)), _spare(value))


def _spare(value: Column) -> Column:
    return F.greatest(F.length(F.bin(value)) - LEADING_BITS, F.lit(0))


def bucket_end(least: Column) -> Column:
    """The greatest value of a bucket."""
    return least + F.call_function("shiftleft", F.lit(1).cast("bigint"), _spare(least)) - 1


def sketches(measured: DataFrame) -> DataFrame:
    """``lang, source, measure, bucket, n``: documents of each source per bucket."""
    values = F.array(
        *[F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket")) for m in FENCES]
    )
    return (
        measured.select("lang", "source", F.explode(values).alias("v"))
        .groupBy("lang", "source", "v.measure", "v.bucket")
        .agg(F.count("*").alias("n"))
    )


def _whole(column: str) -> Column:
    return F.col(column).cast("decimal(38,0)")


def backed_off(sketch: DataFrame, backoff: int = BACKOFF) -> DataFrame:
    """``lang, source, measure, bucket, n``: each source's sketch with its shares of the upper ones.

    A source of S documents, in a language of L and a table of A, has per bucket
    ``s + backoff * (l + backoff * a / A) / (L + backoff)``. All buckets of a source
    are given as whole multiples of this, so that no engine rounds. Only the
    buckets of all documents, at most 2,000 per measure, are broadcast.
    """
    groups = sketch.groupBy("lang", "source", "measure").agg(F.lit(0).alias("one")).drop("one")
    of_lang = sketch.groupBy("lang", "measure", "bucket").agg(F.sum("n").alias("l"))
    of_all = of_lang.groupBy("measure", "bucket").agg(F.sum("l").alias("a"))
    # Sizes per language, with the size of all; every document has one value of each measure.
    sizes = of_lang.groupBy("lang", "measure").agg(F.sum("l").alias("in_lang"))
    everything = of_all.groupBy("measure").agg(F.sum("a").alias("in_all"))
    sizes = sizes.join(F.broadcast(everything), "measure").select(
        F.col("lang").alias("of"), F.col("measure").alias("m"), "in_lang", "in_all"
    )
    known = groups.join(sizes, F.col("lang").eqNullSafe(F.col("of")) & (F.col("measure") == F.col("m"))).drop("of", "m")
    keys = ["lang", "source", "measure"]
    own = known.select(*[F.col(k).alias(f"k_{k}") for k in keys], "in_lang", "in_all")
    same = [F.col(k).eqNullSafe(F.col(f"k_{k}")) for k in keys]
    own = sketch.join(own, same[0] & same[1] & same[2]).select(
        *keys, "bucket", (_whole("n") * _whole("in_all") * (_whole("in_lang") + backoff)).alias("n")
    )
    shared = of_lang.select(F.col("lang").alias("of"), F.col("measure").alias("m"), "bucket", "l")
    shared = known.join(shared, F.col("lang").eqNullSafe(F.col("of")) & (F.col("measure") == F.col("m"))).select(
        *keys, "bucket", (backoff * _whole("l") * _whole("in_all")).alias("n")
    )
    common = known.join(F.broadcast(of_all), "measure").select(
        *keys, "bucket", (backoff * backoff * _whole("a")).alias("n")
    )
    parts = own.union(shared).union(common)
    return parts.groupBy(*keys, "bucket").agg(F.sum("n").cast("decimal(38,0)").alias("n"))


def limits(sketch: DataFrame) -> DataFrame:
    """One row per source: ``lang, source`` and a lower and upper limit per measure."""
    group = "lang, source, measure"
    ranked = sketch.selectExpr(
        "*",
        f"cast(sum(n) over (partition by {group} order by bucket) as decimal(38,0)) as below",
        f"cast(sum(n) over (partition by {group}) as decimal(38,0)) as size",
    )
    quartiles = ranked.groupBy("lang", "source", "measure").agg(
        F.min(F.expr("case when 4 * below >= size then bucket end")).alias("q1"),
        F.min(F.expr("case when 4 * below >= 3 * size then bucket end")).alias("q3"),
    )
    found = []
    for measure, fence in FENCES.items():
        reach = F.greatest(fence.reach * (F.col("q3") - F.col("q1")), F.lit(fence.slack))
        is_it = F.col("measure") == measure
        low = F.col("q1") - reach if fence.low else F.lit(None).cast("bigint")
        found += [
            F.max(F.when(is_it, low)).alias(f"{measure}_low"),
            F.max(F.when(is_it, bucket_end(F.col("q3")) + reach)).alias(f"{measure}_high"),
        ]
    return quartiles.groupBy("lang", "source").agg(*found)


def quality_rules(
    docs: DataFrame,
    lang_column: str = "lang",
    source_column: str = "source",
    text_column: str = "text",
    carry: DataFrame | None = None,
    backoff: int = BACKOFF,
) -> DataFrame:
    """The rows with the counts of ``RESULTS``, ``base_failed`` and ``kept``.

    A document is kept if the base rule does not fail it and each of its measures
    lies within the limits of its language and source. To the documents of a source
    its limits add ``backoff`` more from its language, and to those of a language as
    many from all. All documents count for the sketches, failed ones too.

    Null texts have no words, so the base rule fails them, as it does empty ones.
    A null language or source is a group of its own. Repeated rows each count.
    ``carry`` (a selection of ``docs``) says which columns come back, all by
    default; those named like a result are replaced. An empty table stays empty.
    """
    carried = docs if carry is None else carry
    measured = written(
        _measured(docs, carried, lang_column, source_column, text_column), "measured"
    )
    found = limits(backed_off(written(sketches(measured), "sketches"), backoff))
    names = [c for c in found.columns if c not in ("lang", "source")]
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    bounds = written(
        found.select(F.col("lang").alias("l"), F.col("source").alias("s"), F.struct(*names).alias("limits")), "limits"
    ).select("*", salts.alias("part"))
    # Measured rows are stored, so a task that runs again gives each row the same salt.
    salted = measured.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    joined = salted.join(
        bounds,
        salted["lang"].eqNullSafe(bounds["l"])
        & salted["source"].eqNullSafe(bounds["s"])
        & (salted["salt"] == bounds["part"]),
    )
    within = F.lit(True)
    for measure in FENCES:
        low, high = F.col(f"limits.{measure}_low"), F.col(f"limits.{measure}_high")
        within &= (low.isNull() | (F.col(measure) >= low)) & (F.col(measure) <= high)
    judged = joined.select(
        "row", *[F.col(f"counts.{c}") for c in COUNTS[:5]], "base_failed", (~F.col("base_failed") & within).alias("kept")
    )
    return judged.select(unpacked(carried.columns, RESULTS))
