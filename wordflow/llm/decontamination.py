"""Benchmark passages in documents, found by spaced seeds.

A window of ``WINDOW`` words is cut into four interleaved classes of positions.
A mask keeps two classes and ignores the others; there are six masks. Any two
substitutions touch at most two classes, so one mask sees none of them: windows
that differ in up to two words share the hash of a mask, wherever they differ.
Hits are verified word by word and joined along the passage.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordflow.llm.common import written

WINDOW = 12
CLASSES = 4
MASKS = list(combinations(range(CLASSES), 2))
MAX_SUBSTITUTIONS = 2
# A document goes if it has so many percent of an item's words, in such windows along one alignment.
MIN_COVERAGE = 20
# Scripts that set no blanks between words, whose characters are words each: Thai, Lao,
# Burmese, Khmer, kana, Han. Ranges of code points, fixed values.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]")
# Deleted before words are compared.
PUNCTUATION = b".,;:!?\"'()[]{}"
# Bits of the filter of benchmark hashes that every task holds: 8 MiB, whatever the benchmark.
FILTER_BITS = 26
BITMAP_BITS = 32768
# Words that are hashed together.
WORDS = 1 << 18

_ODD = np.random.default_rng(7).integers(0, 1 << 63, 8 + WINDOW, np.uint64) * np.uint64(2) + np.uint64(1)
MIX = np.uint64(0xBF58476D1CE4E5B9)
SHIFT = np.uint64(31)

HITS = "doc string, place bigint, content bigint, words array<bigint>"
TEST = "mask int, seed bigint, item_id bigint, item_place bigint, words array<bigint>"


def normal_words(text: str | None) -> list[bytes]:
    """Words without punctuation, A-Z lowered; of scripts without blanks every character."""
    if not text:
        return []
    if not text.isascii():
        text = _UNSPACED.sub(r" \g<0> ", text)
    return text.encode().lower().translate(None, PUNCTUATION).split()


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> SHIFT)) * MIX
    return values ^ (values >> SHIFT)


def _hashed(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words in a row, and the number of words of each text."""
    sizes = np.array([len(words) for words in texts], np.int64)
    flat = (word for words in texts for word in words)
    return np.fromiter(map(xxhash.xxh64_intdigest, flat), np.uint64, int(sizes.sum())), sizes


class Windows:
    """The windows of ``width`` words of many texts, by the hashes of their words."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray, width: int = WINDOW) -> None:
        self.words, self.width = words, width
        owner = np.repeat(np.arange(len(sizes)), sizes)
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        n = max(0, len(words) - width + 1)
        #: Starts of windows that lie within one text.
        self.starts = np.flatnonzero(owner[:n] == owner[width - 1 :][:n]) if n else np.zeros(0, np.int64)
        self.owner = owner[self.starts]
        self.place = self.starts - first[self.starts]

    def seeds(self) -> Iterator[tuple[int, np.ndarray]]:
        """Masks, and the hash of the words that each keeps, for each window."""
        if self.width < WINDOW:
            yield len(MASKS) + self.width, _mixed(self.contents(np.arange(len(self.starts))))
            return
        rows = WINDOW // CLASSES
        span = len(self.words) - CLASSES * (rows - 1)
        lines = sum(
            self.words[CLASSES * k : CLASSES * k + max(0, span)] * _ODD[k] for k in range(rows)
        ) if span > 0 else self.words[:0]
        for mask, (a, b) in enumerate(MASKS):
            kept = lines[self.starts + a] * _ODD[3 + a] + lines[self.starts + b] * _ODD[3 + b]
            yield mask, _mixed(kept ^ _ODD[CLASSES * a + b])

    def at(self, chosen: np.ndarray) -> np.ndarray:
        return self.words[self.starts[chosen][:, None] + np.arange(self.width)]

    def contents(self, chosen: np.ndarray) -> np.ndarray:
        """A hash of all words of windows, which tells their widths apart too."""
        summed = (self.at(chosen) * _ODD[8 : 8 + self.width]).sum(axis=1, dtype=np.uint64)
        return _mixed(summed + np.uint64(WINDOW - self.width))


def _grouped(texts: pd.Series) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Words of some rows at a time, with the first row's number."""
    begin, held, size = 0, [], 0
    for text in texts:
        held.append(normal_words(text))
        size += len(held[-1])
        if size >= WORDS:
            yield begin, held
            begin, held, size = begin + len(held), [], 0
    if held:
        yield begin, held


def _test_seeds(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All seeds of the items: of their windows, or of a short item as a whole."""
    for frame in frames:
        ids = frame["item_id"].to_numpy()
        for begin, texts in _grouped(frame["text"]):
            lengths = np.array([len(t) for t in texts])
            for width in sorted({min(n, WINDOW) for n in lengths.tolist() if n}):
                own = np.flatnonzero(np.minimum(lengths, WINDOW) == width)
                windows = Windows(*_hashed([texts[i] for i in own]), width)
                words = list(windows.at(np.arange(len(windows.starts))).view(np.int64))
                for mask, seeds in windows.seeds():
                    yield pd.DataFrame(
                        {
                            "mask": np.full(len(words), mask, np.int32),
                            "seed": seeds.view(np.int64),
                            "item_id": ids[begin + own[windows.owner]],
                            "item_place": windows.place,
                            "words": words,
                        }
                    )


def _filter_of(test: DataFrame) -> np.ndarray:
    """One bit per leading bits of a seed, set if a test window has such a seed.

    Bitmaps are made in the tasks; the driver gets ``2 ** FILTER_BITS`` bits at most.
    """
    slot = F.shiftrightunsigned("seed", 64 - FILTER_BITS) + 1
    pieces = test.groupBy(F.bitmap_bucket_number(slot).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    )
    bits = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    size = BITMAP_BITS // 8
    for piece, part in pieces.collect():
        bits[(piece - 1) * size : piece * size] = np.frombuffer(bytes(part), np.uint8)
    return bits


def _document_hits(shared, widths: list[int]):
    """Windows with a seed that passes the filter; the words of a content once per task."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = shared.value
        known: set[int] = set()
        for frame in frames:
            ids = frame["doc"]
            for begin, texts in _grouped(frame["text"]):
                words, sizes = _hashed(texts)
                for width in widths:
                    windows = Windows(words, sizes, width)
                    passed = np.zeros(len(windows.starts), bool)
                    for _, seeds in windows.seeds():
                        slots = seeds >> np.uint64(64 - FILTER_BITS)
                        passed |= (bits[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1 > 0
                    chosen = np.flatnonzero(passed)
                    if len(chosen):
                        contents = windows.contents(chosen).view(np.int64)
                        found = windows.at(chosen).view(np.int64)
                        fresh = [c not in known and not known.add(c) for c in contents.tolist()]
                        yield pd.DataFrame(
                            {
                                "doc": ids.iloc[begin + windows.owner[chosen]].to_numpy(),
                                "place": windows.place[chosen],
                                "content": contents,
                                "words": [w if new else None for w, new in zip(found, fresh, strict=True)],
                            }
                        )
                if len(known) > WORDS:
                    known.clear()

    return rows


def _content_seeds(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All seeds of distinct windows."""
    for frame in frames:
        lengths = frame["words"].map(len).to_numpy()
        for width in np.unique(lengths).tolist():
            own = frame[lengths == width]
            words = np.stack(own["words"].to_numpy()).astype(np.int64).view(np.uint64)
            windows = Windows(words.ravel(), np.full(len(words), width), width)
            for mask, seeds in windows.seeds():
                yield pd.DataFrame(
                    {
                        "content": own["content"].to_numpy(),
                        "mask": np.full(len(words), mask, np.int32),
                        "seed": seeds.view(np.int64),
                        "seen": list(own["words"]),
                    }
                )


def _substitutions() -> Column:
    pairs = F.zip_with("seen", "words", lambda a, b: (a != b).cast("int"))
    return F.aggregate(pairs, F.lit(0), lambda total, x: total + x)


def _covered() -> Column:
    """Words that the windows of ``width`` words at the sorted ``places`` cover."""
    begin = F.struct((-F.col("width")).alias("last"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(
        "places",
        begin,
        lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.col("width"), x - a["last"])).alias("n")),
        lambda a: a["n"],
    )


def _leaks(docs: DataFrame, benchmark: DataFrame, item_column: str, text_column: str, max_substitutions: int) -> DataFrame:
    """``doc, item_id, overlap, coverage, substitutions, doc_place, item_place`` from ``doc`` (a string) and ``text``."""
    spark = docs.sparkSession
    if max_substitutions > CLASSES - 2:
        raise ValueError("the masks are made for two substitutions at most")
    items = benchmark.select(
        F.col(f"`{item_column}`").cast("bigint").alias("item_id"), F.col(f"`{text_column}`").alias("text")
    )
    distinct = items.filter(F.col("text").isNotNull()).groupBy("text").agg(F.min("item_id").alias("item_id"))
    test = written(distinct.select("item_id", "text").mapInPandas(_test_seeds, TEST), "seeds")
    shared = spark.sparkContext.broadcast(_filter_of(test))
    # As many as a window has words at most.
    widths = sorted(r[0] for r in test.select(F.size("words")).distinct().collect())
    hits = written(docs.select("doc", "text").mapInPandas(_document_hits(shared, widths), HITS), "hits")
    contents = hits.filter(F.col("words").isNotNull()).groupBy("content").agg(F.first("words").alias("words"))
    seeds = contents.mapInPandas(_content_seeds, "content bigint, mask int, seed bigint, seen array<bigint>")
    # What is shorter than a window must be there word by word.
    allowed = F.when(F.col("mask") < len(MASKS), F.lit(max_substitutions)).otherwise(0)
    found = (
        seeds.join(test, ["mask", "seed"])
        .withColumn("substitutions", _substitutions())
        .filter((F.size("seen") == F.size("words")) & (F.col("substitutions") <= allowed))
        .select("content", "item_id", "item_place", "substitutions", F.size("words").cast("bigint").alias("width"))
        .distinct()
    )
    verified = written(found, "verified")
    aligned = (
        hits.select("doc", "place", "content")
        .join(verified, "content")
        .groupBy("doc", "item_id", "width", (F.col("place") - F.col("item_place")).alias("shift"))
        .agg(
            F.sort_array(F.collect_set("item_place")).alias("places"),
            F.min("substitutions").alias("substitutions"),
        )
        .select(
            "doc",
            "item_id",
            F.struct(
                _covered().alias("overlap"),
                (-F.col("substitutions")).alias("fewest"),
                (-(F.col("places")[0] + F.col("shift"))).alias("first"),
                (-F.col("places")[0]).alias("item_first"),
            ).alias("best"),
        )
        .groupBy("doc", "item_id")
        .agg(F.max("best").alias("best"))
    )
    lengths = test.groupBy("item_id").agg(F.max(F.col("item_place") + F.size("words")).alias("item_words"))
    return aligned.join(lengths, "item_id").select(
        "doc",
        "item_id",
        F.col("best.overlap").alias("overlap"),
        F.expr("100 * best.overlap div item_words").alias("coverage"),
        (-F.col("best.fewest")).alias("substitutions"),
        (-F.col("best.first")).alias("doc_place"),
        (-F.col("best.item_first")).alias("item_place"),
    )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    max_substitutions: int = MAX_SUBSTITUTIONS,
) -> DataFrame:
    """``doc_id, item_id, overlap, coverage, substitutions, doc_place, item_place`` per leak.

    A document leaks an item if a window of ``WINDOW`` words of the one differs
    from a window of the other in ``max_substitutions`` words or fewer (two at
    most). An item of fewer words is leaked by a document that has all its words in
    a row. ``overlap`` is the number of the item's words in such windows along the
    best alignment of the two, ``coverage`` its share of the item, in whole
    percent; ``substitutions`` are those of its best window, and the places are
    where the alignment begins, counted in words. Words are compared without
    ``PUNCTUATION`` and with A-Z lowered; every character of a script without
    blanks is a word. All such windows are found: the masks miss none, and the
    filter only lets more through.

    Null texts and those without words leak nothing and are not leaked, and a
    document shorter than an item's windows does not leak it. Rows without an id are reported under a null id; rows
    that share an id count as one. Items with the same text are reported under
    the smallest of their ids. Empty tables give an empty table.
    """
    # Ids travel as text: pandas would turn whole numbers with nulls into floats.
    read = docs.select(
        F.col(f"`{id_column}`").cast("bigint").cast("string").alias("doc"), F.col(f"`{text_column}`").alias("text")
    )
    found = _leaks(read, benchmark, item_column, item_text_column, max_substitutions)
    return found.select(F.col("doc").cast("bigint").alias("doc_id"), *found.columns[1:])


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    max_substitutions: int = MAX_SUBSTITUTIONS,
    min_coverage: int = MIN_COVERAGE,
) -> DataFrame:
    """The documents that do not have ``min_coverage`` percent of an item's words or more, as they are.

    Documents are judged by their texts, so rows without an id are too, and copies
    alike. A stock phrase that a longer item has too is not enough to lose one.
    """
    digest = F.md5(F.col(f"`{text_column}`"))
    read = docs.select(digest.alias("doc"), F.col(f"`{text_column}`").alias("text"))
    leaks = _leaks(read, benchmark, item_column, item_text_column, max_substitutions)
    leaking = written(leaks.filter(F.col("coverage") >= min_coverage).select("doc").distinct(), "leaking")
    return docs.join(leaking, digest == leaking["doc"], "left_anti")
