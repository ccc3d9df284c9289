"""Alignment of two tokenizers over the same bytes, by galloping intersection.

Both token lists of a text are lists of byte offsets where tokens end. The shorter
one drives: each of its ends is looked up in the longer one by steps that double
and then by halving. Ends that both have cut the tokens into groups, and how far
the found places lie apart says which tokens of the one overlap which of the other.

Pairs of ids whose tokens end together are counted over the whole corpus. Texts
are put into chunks, and a chunk asks the table of counts for each of its pairs
once, so what is shuffled are distinct pairs per chunk, not places.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordflow.llm.common import packed, unpacked, written

#: Links of a chunk, which asks for each of its pairs once.
LINKS = 1 << 20
# Characters that are encoded together.
CHARS = 1 << 19
# Ends are looked up in steps: first every 512th, then every 64th from there, and so on.
PIVOTS = (512, 64, 8, 1)
# Fixed value: what the byte-level pre-tokenizer splits texts by.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RESULTS = ["n_a", "n_b", "n_groups", "n_overlaps", "n_links", "n_best", "count_sum", "groups"]


def byte_letters() -> dict[str, int]:
    """The byte of each letter in which byte-level vocabularies are written.

    Printable bytes of Latin-1 stand for themselves, the others for the letters
    from 256 on, in their order.
    """
    shown = [b for b in range(256) if chr(b).isprintable() and b != 32 and b != 0xAD]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def piece_bytes(piece: str) -> bytes:
    """The bytes of a piece: blanks are written as U+2581, single bytes as <0xHH>."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def byte_level(path: str) -> tuple[Callable[[list[str]], list[list[int]]], list[bytes]]:
    """The encoder of a byte-level tokenizer file, and the bytes of its ids.

    Where merges are ranked as their ids are, and nothing but the usual pattern
    splits texts, ranks say it all, and the faster library for ranks gives the same ids.
    """
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    letters, names = byte_letters(), dict(told["model"]["vocab"])
    spelled = {n: bytes(letters[c] for c in name) for name, n in names.items() if all(c in letters for c in name)}
    spelled |= {extra["id"]: extra["content"].encode() for extra in told.get("added_tokens") or []}
    merges = ("".join(m) if isinstance(m, list) else m.replace(" ", "") for m in told["model"]["merges"])
    usual = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    by_rank = all(names[joined] == 256 + i for i, joined in enumerate(merges)) and sorted(
        names[c] for c in letters
    ) == list(range(256))
    table = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
    odd = {k for k, v in told["model"].items() if v and k not in ("type", "vocab", "merges")}
    if by_rank and told["pre_tokenizer"] == usual and told["normalizer"] is None and not odd:
        import tiktoken

        ranks = {spelled[n]: n for n in names.values()}
        own = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [own.encode_ordinary(t) for t in texts], table
    # Spark's tasks are the parallelism.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    return lambda texts: [e.ids for e in whole.encode_batch_fast(texts, add_special_tokens=False)], table


class Tokenizers:
    """A byte-level tokenizer (A) and a piece model (B), with the bytes of all their tokens."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        import sentencepiece

        self.encode_a, self.bytes_a = byte_level(byte_path)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.bytes_b = [piece_bytes(self.pieces.id_to_piece(i)) for i in range(self.pieces.get_piece_size())]
        self.sizes_a, self.sizes_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        # How an id is written within its group and side, and as the last one there.
        self.shown = [f"{i}{mark}" for i in range(len(self.bytes_a)) for mark in ",|"]
        self.shown += [f"{i}{mark}" for i in range(len(self.bytes_b)) for mark in ",;"]

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Both ids of each text; none where the bytes of either are not those of the text behind a blank."""
        first = self.encode_a([f" {t}" for t in texts])
        second = self.pieces.encode(texts, num_threads=1)
        found = []
        for text, a, b in zip(texts, first, second, strict=True):
            whole = b" " + text.encode()
            same = text and all(
                b"".join(map(table.__getitem__, ids)) == whole for table, ids in ((self.bytes_a, a), (self.bytes_b, b))
            )
            found.append((a, b) if same else ([], []))
        return found


@lru_cache(maxsize=1)
def tokenizers(byte_path: str, piece_path: str) -> Tokenizers:
    """Once per process."""
    return Tokenizers(byte_path, piece_path)


def gallop(ends: np.ndarray, wanted: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The first place from ``begin`` on whose end is not under the wanted one; there is one."""
    low, high = begin.copy(), begin.copy()
    on, step = np.arange(len(wanted)), 1
    while len(on):
        under = ends[high[on]] < wanted[on]
        on = on[under]
        low[on] = high[on] + 1
        high[on] = np.minimum(high[on] + step, len(ends) - 1)
        step *= 2
    on = np.flatnonzero(low < high)
    while len(on):
        middle = (low[on] + high[on]) // 2
        under = ends[middle] < wanted[on]
        low[on] = np.where(under, middle + 1, low[on])
        high[on] = np.where(under, high[on], middle)
        on = on[low[on] < high[on]]
    return low


def ranks(driving: np.ndarray, longer: np.ndarray, first: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Places in ``longer`` of all ``driving`` ends. ``first`` and ``begin``: per driving end its text's first token in either list."""
    place = np.arange(len(driving)) - first
    found = begin.copy()
    for wide, near in zip((None, *PIVOTS), PIVOTS):
        chosen = np.flatnonzero(place % near == 0)
        # From where the last one of the wider steps was found.
        at = first[chosen] + (place[chosen] // wide * wide if wide else 0)
        found[chosen] = gallop(longer, driving[chosen], found[at])
    return found


class Alignment:
    """The tokens of several texts side by side, with offsets that run on from text to text."""

    def __init__(self, known: Tokenizers, encoded: list[tuple[list[int], list[int]]]) -> None:
        self.known = known
        self.a, self.b = (np.concatenate([np.zeros(0, np.int64), *[np.array(e[k], np.int64) for e in encoded]]) for k in (0, 1))
        self.n_a, self.n_b = (np.array([len(e[k]) for e in encoded], np.int64) for k in (0, 1))
        self.first_a, self.first_b = (np.cumsum(n) - n for n in (self.n_a, self.n_b))
        ends_a, ends_b = np.cumsum(known.sizes_a[self.a]), np.cumsum(known.sizes_b[self.b])
        short_a = self.n_a <= self.n_b
        one = self._drive(ends_a, ends_b, short_a, self.n_a, self.first_a, self.first_b)
        two = self._drive(ends_b, ends_a, ~short_a, self.n_b, self.first_b, self.first_a)
        #: Places in A and B of tokens that end together, in order.
        self.last_a = np.sort(np.concatenate([one[0], two[1]]))
        self.last_b = np.sort(np.concatenate([one[1], two[0]]))
        #: Pairs of tokens that overlap, per text.
        self.overlaps = one[2] + two[2]
        owner = np.repeat(np.arange(len(encoded)), self.n_a)
        self.groups = np.bincount(owner[self.last_a], minlength=len(encoded))

    @staticmethod
    def _drive(ends, longer, texts, sizes, first, begin) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Common places of both lists, and overlaps per text, for the chosen texts."""
        owner = np.repeat(np.arange(len(sizes)), sizes)
        own = np.flatnonzero(texts[owner])
        owner = owner[own]
        # In the chosen texts only, where each text's first token stands.
        starts = np.searchsorted(own, first[owner])
        places = ranks(ends[own], longer, starts, begin[owner])
        common = longer[places] == ends[own] if len(own) else np.zeros(0, bool)
        # A token starts where the one before ends: within that one's last partner, or behind it.
        before = np.where(np.arange(len(own)) == starts, begin[owner], np.roll(places + common, 1))
        overlaps = np.bincount(owner, places - before + 1, len(sizes)).astype(np.int64)
        return own[common], places[common], overlaps

    def pairs(self) -> np.ndarray:
        """Ids of the links, A's in the upper half."""
        return self.a[self.last_a] << 32 | self.b[self.last_b]

    def shown(self) -> list[str]:
        """Per text its groups as ``a1,a2|b1;a3|b2,b3``."""
        last_a, last_b = (np.zeros(len(x), np.int64) for x in (self.a, self.b))
        last_a[self.last_a], last_b[self.last_b] = 1, 1
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        # Behind the B tokens of all groups before, and behind the A tokens of its own group too.
        upto_b = np.concatenate([[0], self.last_b + 1])[np.cumsum(last_a) - last_a]
        codes[np.arange(len(self.a)) + upto_b] = 2 * self.a + last_a
        upto_a = (self.last_a + 1)[np.cumsum(last_b) - last_b] if len(self.last_a) else np.zeros(0, np.int64)
        codes[np.arange(len(self.b)) + upto_a] = 2 * (len(self.known.bytes_a) + self.b) + last_b
        begin = (self.first_a + self.first_b).tolist()
        end = (self.first_a + self.first_b + self.n_a + self.n_b).tolist()
        table = self.known.shown.__getitem__
        return ["".join(map(table, codes[x:y].tolist()))[:-1] for x, y in zip(begin, end, strict=True)]


COUNTS = ["n_a", "n_b", "n_groups", "n_overlaps"]
CHUNKS = (
    "chunk bigint, keys array<string>, "
    + ", ".join(f"{c} array<bigint>" for c in COUNTS)
    + ", groups array<string>, pairs array<bigint>, n array<bigint>, places binary"
)


def _slices(frame: pd.DataFrame) -> Iterator[tuple[list[str], list[str]]]:
    keys: list[str] = []
    texts: list[str] = []
    size = 0
    for key, text in zip(frame["key"], frame["text"], strict=True):
        keys.append(key)
        texts.append(text)
        size += len(text)
        if size >= CHARS:
            yield keys, texts
            keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def _chunks(byte_path: str, piece_path: str, digest: bool):
    """Texts of about ``LINKS`` links with their own figures, and the links as places in a list of distinct pairs."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = tokenizers(byte_path, piece_path)
        # Numbered by task and turn, the same whenever the task runs.
        numbers = count(TaskContext.get().partitionId() << 32)
        held: dict[str, list] = {c: [] for c in ("keys", *COUNTS, "groups")}
        links: list[np.ndarray] = []

        def made() -> pd.DataFrame:
            pairs, places, n = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
            packed_ = zlib.compress(places.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)
            row = {"chunk": next(numbers), **held, "pairs": pairs, "n": n, "places": packed_}
            return pd.DataFrame({name: [value] for name, value in row.items()})

        for frame in frames:
            for keys, texts in _slices(frame):
                found = Alignment(known, known.encode(texts))
                shown = found.shown()
                if digest:
                    shown = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in shown]
                new = keys, found.n_a, found.n_b, found.groups, found.overlaps, shown
                for values, more in zip(held.values(), new, strict=True):
                    values.extend(more)
                links.append(found.pairs())
                if sum(map(len, links)) >= LINKS:
                    yield made()
                    held, links = {c: [] for c in held}, []
        if links:
            yield made()

    return run


FINISHED = "key string, " + ", ".join(f"{c} bigint" for c in RESULTS[:-1]) + ", groups string"


def _finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per text what its links' counts come to."""
    for frame in frames:
        for row in frame.itertuples():
            parts = np.frombuffer(zlib.decompress(row.places), np.uint8).reshape(4, -1)
            places = np.ascontiguousarray(parts.T).view("<u4").ravel()
            owner = np.repeat(np.arange(len(row.keys)), row.n_groups)
            whole, best = np.asarray(row.whole, np.int64), np.asarray(row.best, np.int64)
            sums = np.zeros((2, len(row.keys)), np.int64)
            for total, values in zip(sums, (best, whole), strict=True):
                np.add.at(total, owner, values[places])
            figures = {c: getattr(row, c) for c in COUNTS}
            ends = {"n_links": row.n_groups, "n_best": sums[0], "count_sum": sums[1], "groups": row.groups}
            yield pd.DataFrame({"key": row.keys, **figures, **ends})


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``pair, whole, best``: links of a pair of ids in the corpus, and 1 if no pair of its B id has more; stored.

    A B id has as many pairs as A has ids at most, whatever the corpus.
    """
    counted = chunks.select(F.explode(F.arrays_zip("pairs", "n")).alias("p")).groupBy(F.col("p.pairs").alias("pair"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    best = F.max("whole").over(of_b) == F.col("whole")
    return written(
        counted.agg(F.sum("p.n").alias("whole")).select("pair", "whole", best.cast("int").alias("best")), "pairs"
    )


def align_tokenizers(
    docs: DataFrame,
    byte_path: str,
    piece_path: str,
    text_column: str = "text",
    carry: DataFrame | None = None,
    digest: bool = False,
) -> DataFrame:
    """The rows with ``n_a, n_b, n_groups, n_overlaps, n_links, n_best, count_sum, groups``.

    A is the byte-level tokenizer of ``byte_path`` on a blank and the text, B the
    piece model of ``piece_path`` on the text. ``n_groups`` counts the shortest
    stretches that both cut alike, ``groups`` writes their ids
    (``a1,a2|b1;a3|b2,b3``; with ``digest`` the SHA-256 of that, which saves
    storing it). ``n_overlaps`` counts pairs of tokens that share a byte, ``n_links`` those
    that end together. The count of a pair of ids is its links in all rows:
    ``count_sum`` adds it up over the row's links, and ``n_best`` counts the links
    whose count is the highest of their B id, ties included.

    Null and empty texts, and those whose bytes a tokenizer changes, have no tokens:
    zeros and an empty ``groups``. Repeated rows and copies count as often as they
    stand there and have equal results. Marks of special tokens in a text are text.
    ``carry`` (a selection of ``docs``) says which columns come back, those named
    like results replaced. An empty table stays empty.
    """
    carried = docs if carry is None else carry
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    # The results of a text depend on the text and the corpus, so its digest finds its rows again.
    rows = written(docs.select(packed(carried), F.md5(text).alias("key")), "rows")
    texts = docs.select(F.md5(text).alias("key"), text.alias("text"))
    chunks = written(texts.mapInPandas(_chunks(byte_path, piece_path, digest), CHUNKS), "chunks")
    asked = chunks.select("chunk", F.explode("pairs").alias("pair")).join(pair_counts(chunks), "pair")
    answers = asked.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("pair", "whole", "best"))).alias("found"))
    none = F.expr("cast(array() as array<bigint>)")
    whole, best = (F.coalesce(F.col(f"found.{c}").cast("array<bigint>"), none).alias(c) for c in ("whole", "best"))
    answered = chunks.drop("pairs", "n").join(answers, "chunk", "left").select("*", whole, best).drop("found")
    finished = answered.mapInPandas(_finish, FINISHED)
    # Copies of a text have equal results, so any of them will do.
    once = written(finished.groupBy("key").agg(F.max(F.struct(*RESULTS)).alias("made")), "aligned")
    return rows.join(once, "key").select("row", "made.*").select(unpacked(carried.columns, RESULTS))
