"""Exact repeated byte strings, by a depth-limited radix sort of suffixes.

Two suffixes that agree for ``length`` bytes are a repeated window. Suffixes are
dealt by most significant digits and singletons are dropped, pass by pass, until
``length`` bytes are used up; groups that are left are the repeated windows. The
digits are picked so that the first pass need not move every suffix:

1. The first digit of a window is its smallest gram: the gram of ``GRAM`` bytes
   with the least hash, the leftmost of equals. Equal windows have the same gram
   at the same offset. Windows next to each other mostly share it, so one row, an
   anchor, stands for all windows around one gram, about 1 in 75 bytes. Anchors
   whose gram is found once are dropped.
2. The second digit is all the text of the anchor's windows. Anchors that agree
   in it are repeated as a whole: copies and the inside of long passages end here.
3. What is left are the rims of passages: anchors with the same gram and
   different text around it. One anchor of each text is sorted by window, to the
   full length. Groups of a gram go to one task each; a gram with very many texts
   is dealt by window instead, so no task depends on how frequent a gram is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordflow.llm.common import packed, unpacked, written

LENGTH = 200
GRAM = 48
# Window starts that are looked at together; longer texts are cut into such blocks.
BLOCK = 1 << 19
# Texts around one gram that a task compares; beyond that they are dealt by window.
GROUP = 4096
# Rows that leave a worker together.
ROWS = 200_000

# An odd multiplier and a random value per byte make a hash that can be moved along a text.
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BYTES = np.random.default_rng(20240229).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
MIX = np.uint64(0xBF58476D1CE4E5B9)
SHIFT = np.uint64(29)

ANCHORS = "doc bigint, at bigint, lo bigint, hi bigint, gram bigint, around bigint"
STARTS = "doc bigint, lo bigint, hi bigint"
WINDOWS = "gram bigint, window bigint, doc bigint, lo bigint, weight int"
NONE = np.zeros(0, np.int64)
# Texts that are cut before their result leaves a worker.
SLICE = 500
RESULTS = ["kept", "n_bytes", "n_removed", "n_spans"]


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 to the 64."""
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    rising, falling = np.full(size, BASE), np.full(size, inverse)
    rising[0] = falling[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(rising), np.multiply.accumulate(falling)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> SHIFT)) * MIX
    return values ^ (values >> SHIFT)


class Hashes:
    """Hashes of any stretch of a text from sums over its beginning."""

    def __init__(self, text: np.ndarray) -> None:
        size = 1 << max(16, int(len(text) + 1).bit_length())
        self.rising, self.falling = _powers(size)
        self.sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(BYTES[text] * self.rising[: len(text)], out=self.sums[1:])

    def every(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return _mixed((self.sums[width:] - self.sums[:n]) * self.falling[:n])

    def of(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[ends] - self.sums[begins]) * self.falling[begins])


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values the place of the least one, the leftmost of equals."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    places = np.arange(blocks * width, dtype=np.int64).reshape(blocks, width)
    # From the left a smaller value takes over, from the right an equal one does too.
    least = np.minimum.accumulate(grid, axis=1)
    fresh = np.ones(grid.shape, bool)
    fresh[:, 1:] = grid[:, 1:] < least[:, :-1]
    ahead = np.maximum.accumulate(np.where(fresh, places, -1), axis=1).ravel()
    back = grid[:, ::-1]
    least_back = np.minimum.accumulate(back, axis=1)
    fresh[:, 1:] = back[:, 1:] <= least_back[:, :-1]
    far = np.iinfo(np.int64).max
    behind = np.minimum.accumulate(np.where(fresh, places[:, ::-1], far), axis=1)[:, ::-1].ravel()
    starts = np.arange(n - width + 1)
    left, right = behind[starts], ahead[starts + width - 1]
    return np.where(padded[left] <= padded[right], left, right)


def anchors(text: bytes, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``at, lo, hi, gram, around`` of a text: the windows that begin at lo to hi have their least gram at ``at``."""
    raw = np.frombuffer(text, np.uint8)
    width = length - gram + 1
    for begin in range(0, len(raw) - length + 1, BLOCK):
        part = raw[begin : begin + BLOCK + length - 1]
        hashes = Hashes(part)
        grams = hashes.every(gram)
        at = leftmost_least(grams, width)
        lo = np.flatnonzero(np.diff(at, prepend=-1))
        hi = np.append(lo[1:], len(at)) - 1
        at = at[lo]
        shape = ((at - lo) * 1024 + (hi - lo)).astype(np.uint64)
        around = _mixed(hashes.of(lo, hi + length) ^ (shape * MIX))
        yield at + begin, lo + begin, hi + begin, grams[at].view(np.int64), around.view(np.int64)


def _anchor_rows(length: int, gram: int):
    names = [c.split()[0] for c in ANCHORS.split(", ")]

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            parts, size = [], 0
            for doc, text in zip(frame["doc"], frame["text"], strict=True):
                for found in anchors(text.encode(), length, gram):
                    parts.append((np.full(len(found[0]), doc), *found))
                    size += len(found[0])
                if size >= ROWS:
                    yield _stacked(parts, names)
                    parts, size = [], 0
            if parts:
                yield _stacked(parts, names)

    return rows


def _stacked(parts: list[tuple[np.ndarray, ...]], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*parts, strict=True)), strict=True)))


def _judged(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Anchors whose gram is found again: ``n`` with the same text around, ``texts`` different ones."""
    rows = docs.filter(F.octet_length("text") >= length).select("doc", "text").mapInPandas(
        _anchor_rows(length, gram), ANCHORS
    )
    # Stored tables on one side make each join one of two plain shuffles: Spark can then
    # split a frequent gram over tasks.
    counted = rows.groupBy("gram").agg(F.count("*").alias("n"))
    again = written(counted.filter("n > 1").select("gram"), "grams")
    rest = written(rows.join(again, "gram"), "anchors")
    texts = written(
        rest.groupBy("gram", "around").agg(F.count("*").alias("n"), F.min("doc").alias("first")), "texts"
    )
    per_gram = written(texts.groupBy("gram").agg(F.count("*").alias("texts")), "grams")
    known = texts.join(per_gram, "gram").filter("n > 1 or texts > 1")
    return written(rest.join(known, ["gram", "around"]), "anchors")


def _asks(judged: DataFrame, condition: str) -> DataFrame:
    """Per document its anchors that stand for a text around a gram."""
    asked = judged.filter(f"texts > 1 and (n = 1 or doc = first) and {condition}")
    fields = F.struct("at", "lo", "hi", "gram", "n")
    return asked.groupBy("doc").agg(F.collect_set(fields).alias("asks"))


def _texts_around(length: int):
    """Per asked anchor the text of its windows."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["gram", "doc", "at", "lo", "hi", "n", "around"]
        before = None
        for frame in frames:
            found = []
            for doc, text, asks in zip(frame["doc"], frame["text"], frame["asks"], strict=True):
                # Repeated rows are the same text and stand next to each other: one answers.
                if doc == before:
                    continue
                before = doc
                raw = text.encode()
                for a in asks:
                    cut = raw[a["lo"] : a["hi"] + length]
                    found.append((a["gram"], doc, a["at"], a["lo"], a["hi"], a["n"], cut))
                if len(found) >= GROUP:
                    yield pd.DataFrame(found, columns=names)
                    found = []
            if found:
                yield pd.DataFrame(found, columns=names)

    return rows


def _windows_of(lo: np.ndarray, hi: np.ndarray, at: np.ndarray, begins: np.ndarray):
    """Flat over all windows: the row, the place in the joined texts, the offset of the gram."""
    sizes = hi - lo + 1
    row = np.repeat(np.arange(len(lo)), sizes)
    step = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return row, begins[row] + step, at[row] - lo[row] - step, step


def repeated_starts(frame: pd.DataFrame, length: int) -> pd.DataFrame:
    """``doc, lo, hi``: starts of windows that equal one of another row with the same gram."""
    lo, hi, at = (frame[c].to_numpy() for c in ("lo", "hi", "at"))
    gram, n, doc = (frame[c].to_numpy() for c in ("gram", "n", "doc"))
    raw = np.frombuffer(b"".join(frame["around"]), np.uint8)
    begins = np.cumsum(hi - lo + length) - (hi - lo + length)
    row, place, offset, step = _windows_of(lo, hi, at, begins)
    keys = Hashes(raw).of(place, place + length)
    order = np.lexsort((keys, offset, gram[row]))
    r, k, o = row[order], keys[order], offset[order]
    same = (k[1:] == k[:-1]) & (o[1:] == o[:-1]) & (gram[r][1:] == gram[r][:-1])
    twice = np.zeros(len(row), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    # Texts that are found as a whole elsewhere are settled already.
    twice &= n[row] == 1
    before = np.zeros(len(row), bool)
    before[1:] = twice[:-1] & (row[1:] == row[:-1])
    after = np.zeros(len(row), bool)
    after[:-1] = twice[1:] & (row[1:] == row[:-1])
    first, last = np.flatnonzero(twice & ~before), np.flatnonzero(twice & ~after)
    place = lo[row] + step
    return pd.DataFrame({"doc": doc[row[first]], "lo": place[first], "hi": place[last]})


def _compared(length: int):
    """Whole groups of a gram at a time; the rows come sorted by gram."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for frame in frames:
            held.append(frame)
            if sum(map(len, held)) >= GROUP:
                joined = pd.concat(held, ignore_index=True)
                last = joined["gram"].to_numpy() == joined["gram"].iloc[-1]
                if not last.all():
                    yield repeated_starts(joined[~last], length)
                held = [joined[last]]
        if held:
            yield repeated_starts(pd.concat(held, ignore_index=True), length)

    return rows


def _each_window(length: int):
    """A row per window of the asked anchors, with two hashes that name it."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for texts in _texts_around(length)(frames):
            lo, hi, at = (texts[c].to_numpy() for c in ("lo", "hi", "at"))
            raw = np.frombuffer(b"".join(texts["around"]), np.uint8)
            begins = np.cumsum(hi - lo + length) - (hi - lo + length)
            row, place, offset, step = _windows_of(lo, hi, at, begins)
            keys = Hashes(raw).of(place, place + length)
            gram = texts["gram"].to_numpy()[row].view(np.uint64)
            named = _mixed(gram + offset.astype(np.uint64) * MIX)
            yield pd.DataFrame(
                {
                    "gram": named.view(np.int64),
                    "window": keys.view(np.int64),
                    "doc": texts["doc"].to_numpy()[row],
                    "lo": lo[row] + step,
                    "weight": np.minimum(texts["n"].to_numpy()[row], 2).astype(np.int32),
                }
            )

    return rows


def cut(raw: bytes, starts: np.ndarray, length: int) -> tuple[bytes, int, int, int]:
    """The bytes outside all windows that begin in ``starts`` (first and last, packed), and three counts."""
    if not len(starts):
        return raw, len(raw), 0, 0
    edges = np.zeros(len(raw) + 1, np.int64)
    np.add.at(edges, starts >> 32, 1)
    np.add.at(edges, (starts & 0xFFFFFFFF) + length, -1)
    gone = np.cumsum(edges[:-1]) > 0
    spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), len(raw), int(gone.sum()), spans


def _removed(length: int):
    """The cut texts, in Arrow arrays of ``SLICE`` rows: lists of starts never become Python objects."""

    @F.arrow_udf("kept binary, n_bytes bigint, n_removed bigint, n_spans bigint")
    def of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, starts in batches:
            for begin in range(0, max(1, len(texts)), SLICE):
                part, found = texts[begin : begin + SLICE], starts[begin : begin + SLICE]
                rows = [
                    cut(text.as_py().encode(), x.values.to_numpy() if x.is_valid else NONE, length)
                    for text, x in zip(part, found, strict=True)
                ]
                columns = list(zip(*rows, strict=True)) or [[], [], [], []]
                arrays = [pa.array(columns[0], pa.binary())]
                arrays += [pa.array(c, pa.int64()) for c in columns[1:]]
                yield pa.StructArray.from_arrays(arrays, RESULTS)

    return of


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: DataFrame | None = None,
    length: int = LENGTH,
    gram: int = GRAM,
) -> DataFrame:
    """The rows with ``kept`` (bytes), ``n_bytes``, ``n_removed``, ``n_spans``.

    Removed is each byte of a text's UTF-8 that lies in a string of ``length``
    bytes which begins anywhere else too, in the same or another row. Strings may
    overlap, never cross texts, and are judged on the texts as they came in.
    ``n_spans`` counts maximal removed runs.

    Null is like the empty text; texts shorter than ``length`` are kept. Repeated
    rows are repeats of one another; equal ids with different texts are different
    texts. ``carry`` (a selection of ``docs``) says which columns come back, all by
    default, those with the names of the results replaced. An empty table stays
    empty. Texts are told apart by a 64-bit hash of id and text.
    """
    carried = docs if carry is None else carry
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    named = docs.select(
        F.xxhash64(F.col(f"`{id_column}`"), text).alias("doc"), packed(carried), text.alias("text")
    )
    judged = _judged(named, length, gram)
    whole = judged.filter("n > 1").select("doc", "lo", "hi")
    # All columns go through both joins, so that the texts are shuffled once for both.
    few = named.join(_asks(judged, f"texts <= {GROUP}"), "doc")
    many = named.join(_asks(judged, f"texts > {GROUP}"), "doc")
    rims = (
        few.mapInPandas(_texts_around(length), "gram bigint, doc bigint, at bigint, lo bigint, hi bigint, n bigint, around binary")
        .repartition("gram")
        .sortWithinPartitions("gram")
        .mapInPandas(_compared(length), STARTS)
    )
    windows = many.mapInPandas(_each_window(length), WINDOWS)
    twice = windows.groupBy("gram", "window").agg(F.sum("weight").alias("n")).filter("n > 1")
    dealt = windows.join(twice, ["gram", "window"]).select("doc", "lo", F.col("lo").alias("hi"))
    starts = whole.union(rims).union(dealt).groupBy("doc").agg(F.collect_set(F.shiftleft("lo", 32).bitwiseOR(F.col("hi"))).alias("starts"))
    made = named.join(starts, "doc", "left").select(
        "row", _removed(length)(F.col("text"), F.col("starts")).alias("made")
    )
    return made.select("row", "made.*").select(unpacked(carried.columns, RESULTS))
