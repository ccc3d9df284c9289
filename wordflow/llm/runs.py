"""Periodic runs of words, by longest common extensions over a difference cover.

A run of period q and at least four periods holds two words q apart wherever one
starts looking, so of each period only the places 0, 3q, 6q, ... of a text are
tried with the place q further on (the harmonic grid: n log n pairs for n words).
How far the words on both sides of such a pair agree says where the run begins
and ends.

These extensions come from a difference cover: places whose number modulo 7 is 0,
1 or 3. Any two places reach two covered ones within six steps, so few words are
compared one by one, and then the answer for covered suffixes is read off: they,
and no others, are sorted by doubling, and a sparse table over the lengths that
neighbours share gives any two suffixes' common length as a minimum of two cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordflow.llm.common import packed, unpacked, words_of

MODULUS = 7
COVER = (0, 1, 3)
# Pairs of the grid are this many periods apart.
STRIDE = 3
# What a run needs: so many words, and so many periods.
MIN_LENGTH, MIN_PERIODS = 6, 4
# Words, and pairs of the grid, that are looked at together.
WORDS = 1 << 16
PAIRS = 1 << 19
RESULTS = ["n_runs", "runs", "collapsed"]

_COVERED = np.full(MODULUS, -1)
_COVERED[list(COVER)] = np.arange(len(COVER))
#: Steps by which two places, by their numbers modulo 7, both come to covered ones.
_STEPS = np.array(
    [
        [
            next(d for d in range(MODULUS) if _COVERED[(a + d) % MODULUS] >= 0 and _COVERED[(b + d) % MODULUS] >= 0)
            for b in range(MODULUS)
        ]
        for a in range(MODULUS)
    ]
)


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, int]:
    found, ranks = np.unique(keys, return_inverse=True)
    return ranks.astype(np.int64), len(found)


class Extensions:
    """How far two places of one line of numbers agree, both in the same text.

    Texts are parted by numbers that stand nowhere else, before the first one and
    behind the last one too, so that no agreement leaves a text.
    """

    def __init__(self, line: np.ndarray, owner: np.ndarray) -> None:
        self.line = line
        whole = np.arange(0, len(line), MODULUS)
        places = (whole[:, None] + np.array(COVER)).ravel()
        self.places = places[places < len(line)]
        padded = np.concatenate([line, np.full(MODULUS, -1, line.dtype)])
        # Suffixes of different texts are never compared, so the text is their first digit.
        columns = [padded[self.places + k] for k in range(MODULUS)][::-1]
        order = np.lexsort([*columns, owner[self.places]])
        window = np.stack([*columns, owner[self.places]])[:, order]
        fresh = np.concatenate([[0], (window[:, 1:] != window[:, :-1]).any(axis=0)])
        ranks = np.empty(len(order), np.int64)
        ranks[order] = np.cumsum(fresh)
        # Ranks by 7, 14, 28, ... words, until no two suffixes are alike.
        self.levels = [ranks]
        distinct, jump = int(fresh.sum()) + 1, len(COVER)
        while distinct < len(ranks):
            behind = np.full(len(ranks), -1, np.int64)
            behind[:-jump] = ranks[jump:]
            ranks, distinct = _ranked(ranks * (len(ranks) + 1) + behind + 1)
            self.levels.append(ranks)
            jump *= 2
        order = np.empty(len(ranks), np.int64)
        order[ranks] = np.arange(len(ranks))
        # shared[r]: words that the suffixes of ranks r - 1 and r share.
        shared = np.zeros(len(ranks), np.int64)
        shared[1:] = self._neighbours(order[:-1], order[1:])
        self.table = [shared]
        width = 1
        while 2 * width < len(shared):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _neighbours(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common lengths of covered suffixes, from the longest doubling down to single words."""
        a, b, found, n = a.copy(), b.copy(), np.zeros(len(a), np.int64), len(self.places)
        for level in range(len(self.levels) - 1, -1, -1):
            ranks, jump = self.levels[level], len(COVER) << level
            inside = np.maximum(a, b) < n
            same = inside & (ranks[np.minimum(a, n - 1)] == ranks[np.minimum(b, n - 1)])
            found += same * (MODULUS << level)
            a, b = a + same * jump, b + same * jump
        inside = np.flatnonzero(np.maximum(a, b) < n)
        found[inside] += self._by_words(self.places[a[inside]], self.places[b[inside]], np.full(len(inside), MODULUS))[0]
        return found

    def _by_words(self, a: np.ndarray, b: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words that agree, up to ``steps``, and the pairs that agree in all of these."""
        return agreeing(self.line, a, b, steps)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common lengths from the places ``a`` and ``b`` on, which differ."""
        found, on = self._by_words(a, b, _STEPS[a % MODULUS, b % MODULUS])
        if len(on):
            ranks = self.levels[-1]
            x, y = (ranks[self._covered(p[on] + found[on])] for p in (a, b))
            low, high = np.minimum(x, y) + 1, np.maximum(x, y)
            level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
            more = np.empty(len(on), np.int64)
            for k in np.unique(level):
                at = level == k
                cells = self.table[k]
                more[at] = np.minimum(cells[low[at]], cells[high[at] - (1 << int(k)) + 1])
            found[on] += more
        return found

    @staticmethod
    def _covered(places: np.ndarray) -> np.ndarray:
        return places // MODULUS * len(COVER) + _COVERED[places % MODULUS]


def agreeing(line: np.ndarray, a: np.ndarray, b: np.ndarray, steps: np.ndarray, way: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of ``line`` that agree from ``a`` and ``b`` on, up to ``steps``, and the pairs that agree in all of these."""
    found, on = np.zeros(len(a), np.int64), np.arange(len(a))
    step = 0
    done = []
    while len(on):
        over = steps[on] <= step
        done.append(on[over])
        on = on[~over]
        on = on[line[a[on] + way * step] == line[b[on] + way * step]]
        step += 1
        found[on] = step
    return found, np.concatenate(done) if done else on


class Texts:
    """Texts of words in one line, parted by numbers that stand nowhere else."""

    def __init__(self, texts: list[np.ndarray]) -> None:
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.begins = np.cumsum(self.sizes + 1) - self.sizes
        top = max((int(t.max()) for t in texts if len(t)), default=0) + 1
        parts = [np.array([top], np.int64)]
        for i, text in enumerate(texts):
            parts += [text, np.array([top + 1 + i], np.int64)]
        self.line = np.concatenate(parts)
        self.owner = np.concatenate([[0], np.repeat(np.arange(len(texts)), self.sizes + 1)])

    def grid(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Texts, places and periods of pairs of equal words on the harmonic grid, some at a time."""
        most = np.where(self.sizes >= MIN_LENGTH, self.sizes // MIN_PERIODS, 0)
        text = np.repeat(np.arange(len(most)), most)
        period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
        pairs = (self.sizes[text] - period - 1) // (STRIDE * period) + 1
        upto = np.cumsum(pairs)
        begin = 0
        while begin < len(text):
            done = upto[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(upto, done + PAIRS, side="right")))
            counts = pairs[begin:end]
            of = np.repeat(np.arange(begin, end), counts)
            turn = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
            place, step = self.begins[text[of]] + turn * STRIDE * period[of], period[of]
            same = np.flatnonzero(self.line[place] == self.line[place + step])
            yield text[of[same]], place[same], step[same]
            begin = end

    def promising(self) -> np.ndarray:
        """Texts of which a few words on both sides of some pair leave a run possible."""
        seen = np.zeros(len(self.sizes), bool)
        for text, place, step in self.grid():
            few = np.full(len(place), MODULUS)
            right, far_right = agreeing(self.line, place, place + step, few)
            left, far_left = agreeing(self.line, place - 1, place + step - 1, few, way=-1)
            right[far_right], left[far_left] = len(self.line), len(self.line)
            seen[text[right + left + step >= needed(step)]] = True
        return np.flatnonzero(seen)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, start, length and period of all runs, by text, start and period."""
        forward = Extensions(self.line, self.owner)
        last = len(self.line) - 1
        backward = Extensions(self.line[::-1].copy(), self.owner[::-1].copy())
        found = [np.zeros((4, 0), np.int64)]
        for text, place, step in self.grid():
            right = forward(place, place + step)
            left = backward(last - place + 1, last - place - step + 1)
            size = left + step + right
            long = size >= needed(step)
            start = place - left - self.begins[text]
            found.append(_least_period(np.stack([text, start, size, step])[:, long]))
        return tuple(_least_period(np.concatenate(found, axis=1)))


def needed(period: np.ndarray) -> np.ndarray:
    """The words of the shortest run of a period."""
    return np.maximum(MIN_LENGTH, MIN_PERIODS * period)


def _least_period(runs: np.ndarray) -> np.ndarray:
    """A stretch once, with its smallest period: multiples of the period are found too."""
    text, start, size, step = runs
    runs = runs[:, np.lexsort([step, size, start, text])]
    same = (runs[:3, 1:] == runs[:3, :-1]).all(axis=0)
    runs = runs[:, np.concatenate([[True], ~same])[: runs.shape[1]]]
    return runs[:, np.lexsort([runs[3], runs[1], runs[0]])]


def runs_of(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Per text its runs: rows of start, length and period."""
    numbers: dict[bytes, int] = {}
    lines = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in t), np.int64, len(t)) for t in texts]
    none = np.zeros((0, 3), np.int64)
    found = [none] * len(texts)
    chosen = Texts(lines).promising()
    if len(chosen):
        text, *rows = Texts([lines[i] for i in chosen]).runs()
        rows = np.stack(rows, axis=1)
        for k, i in enumerate(chosen):
            low, high = np.searchsorted(text, [k, k + 1])
            found[i] = rows[low:high]
    return found


def without_repeats(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words but those that a run has after its first period."""
    if not len(runs):
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]


def _groups(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    held, size = [], 0
    for text in texts:
        held.append(words_of(text.as_py()))
        size += len(held[-1])
        if size >= WORDS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _lists(rows: list[np.ndarray]) -> list[pa.Array]:
    """Columns of the rows of each text, as lists."""
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.concatenate([np.zeros((0, 3), np.int64), *rows])
    return [pa.ListArray.from_arrays(ends, np.ascontiguousarray(flat[:, k])) for k in range(3)]


def periodic(text: Column) -> Column:
    """``starts, lengths, periods, collapsed`` of each text's words."""

    @F.arrow_udf("starts array<bigint>, lengths array<bigint>, periods array<bigint>, collapsed string")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows: list[np.ndarray] = []
            left: list[str] = []
            for group in _groups(texts):
                found = runs_of(group)
                rows += found
                left += [b" ".join(without_repeats(*pair)).decode() for pair in zip(group, found, strict=True)]
            names = ["starts", "lengths", "periods", "collapsed"]
            yield pa.StructArray.from_arrays([*_lists(rows), pa.array(left, pa.string())], names)

    return of(text)


def periodic_runs(docs: DataFrame, text_column: str = "text", carry: DataFrame | None = None) -> DataFrame:
    """The rows with ``n_runs``, ``runs`` (``start, length, period``, by start and period) and ``collapsed``.

    Words are longest runs without ASCII white space, numbered from 0. A run is a
    stretch of words of smallest period q, at least six words and four periods
    long, that no word on either side extends. ``collapsed`` is the words, joined
    by a blank, without those that some run has after its first q.

    Null, empty and blank texts have no words and no runs, and collapse to an empty
    text. Texts are looked at whole and one by one, so repeated rows and copies
    have equal results. ``carry`` (a selection of ``docs``) says which columns come
    back, those named like results replaced. An empty table stays empty. Nothing
    is shuffled; a task holds the words of one text, or of several small ones.
    """
    carried = docs if carry is None else carry
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    made = docs.select(packed(carried), periodic(text).alias("made"))
    runs = F.transform(
        F.arrays_zip(F.col("made.starts"), F.col("made.lengths"), F.col("made.periods")),
        lambda r: F.struct(r["starts"].alias("start"), r["lengths"].alias("length"), r["periods"].alias("period")),
    )
    return made.select(
        "row",
        F.size("made.starts").cast("bigint").alias("n_runs"),
        runs.alias("runs"),
        F.col("made.collapsed").alias("collapsed"),
    ).select(unpacked(carried.columns, RESULTS))
