"""SentencePiece encoding that keeps offsets, and decoding.

Normalisation replaces the longest prefix known to the model's character map,
again and again, and notes for each new character the byte it came from. Pieces
are then found on the normalised text and projected back to bytes of the text.
"""

from __future__ import annotations

import contextlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordflow.llm.piece_merges import Merges
from wordflow.llm.sentencepiece_model import BYTE, CONTROL, UNKNOWN, Model, load

# Stretches whose pieces a worker remembers, and the longest that is worth it.
CACHE = 150_000
CACHED_CHARS = 64
# From here on a queue finds the next merge faster than a look at all pairs.
LONG = 64
# Characters encoded before their result leaves the worker.
SLICE = 1_000_000
NEVER = float("inf")
# Bytes of an id and a size.
PAIR = 8


Made = dict[str, tuple[str, str]]


def _merge_short(parts: list[str], merges: dict[str, float], made: Made | None) -> list[str]:
    """Merges the best pair, the leftmost of equals, until none is a piece."""
    cost_of = merges.get
    costs = [cost_of(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
    while costs:
        best = min(costs)
        if best == NEVER:
            break
        i = costs.index(best)
        joined = parts[i] + parts[i + 1]
        if made is not None:
            made[joined] = parts[i], parts[i + 1]
        parts[i] = joined
        del parts[i + 1], costs[i]
        if i:
            costs[i - 1] = cost_of(parts[i - 1] + joined, NEVER)
        if i < len(costs):
            costs[i] = cost_of(joined + parts[i + 1], NEVER)
    return parts


def _merge_long(parts: list[str], merges: dict[str, float], made: Made | None) -> list[str]:
    """The same with a queue over a linked list, for long stretches."""
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = [
        (cost, i, parts[i] + parts[i + 1])
        for i in range(n - 1)
        if (cost := merges.get(parts[i] + parts[i + 1], NEVER)) < NEVER
    ]
    heapq.heapify(queue)
    while queue:
        _, i, joined = heapq.heappop(queue)
        j = after[i]
        if not parts[i] or j >= n or parts[i] + parts[j] != joined:
            continue
        if made is not None:
            made[joined] = parts[i], parts[j]
        parts[i], parts[j] = joined, ""
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n:
                cost = merges.get(parts[a] + parts[b], NEVER)
                if cost < NEVER:
                    heapq.heappush(queue, (cost, a, parts[a] + parts[b]))
    return [p for p in parts if p]


def _pieces(model: Model, symbols: list[str], fixed: set[str]) -> list[str]:
    made: Made | None = {} if model.unused else None
    if fixed:
        # A symbol that the model's user defined is never merged with another.
        groups, run = [], []
        for s in symbols:
            if s in fixed:
                groups += [*_pieces(model, run, set()), s]
                run = []
            else:
                run.append(s)
        return groups + (_pieces(model, run, set()) if run else [])
    found = (_merge_long if len(symbols) > LONG else _merge_short)(symbols, model.merges, made)
    if made is None:
        return found
    whole: list[str] = []
    stack = found[::-1]
    while stack:
        piece = stack.pop()
        if piece in model.unused and piece in made:
            stack += made[piece][::-1]
        else:
            whole.append(piece)
    return whole


def encode_stretch(model: Model, stretch: str) -> tuple[list[int], list[int]]:
    """Ids, and the characters that each stands for; all bytes of a character but the last have none."""
    if model.user_words:
        parts = model.user_words.split(stretch)
        fixed = set(parts[1::2])
        symbols = [s for k, p in enumerate(parts) for s in ([p] if k % 2 else p)]
    else:
        fixed, symbols = set(), list(stretch)
    found = _pieces(model, symbols, fixed)
    ids = [model.ids.get(piece) for piece in found]
    if None not in ids:
        return ids, [len(piece) for piece in found]
    ids, sizes = [], []
    for piece in found:
        known = model.ids.get(piece)
        if known is not None:
            ids.append(known)
            sizes.append(len(piece))
        elif model.byte_fallback:
            raw = piece.encode()
            ids += [model.byte_ids[b] for b in raw]
            sizes += [0] * (len(raw) - 1) + [len(piece)]
        elif ids and ids[-1] == model.unknown:
            sizes[-1] += len(piece)
        else:
            ids.append(model.unknown)
            sizes.append(len(piece))
    return ids, sizes


class Encoder:
    """Encodes texts and remembers frequent stretches."""

    def __init__(self, path: str) -> None:
        self.model = load(path)
        self.merges = Merges(self.model)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, stretches: set[str]) -> list[str]:
        """Makes the stretches known, as pairs of id and size; gives those that are too long to keep.

        What was used lately stays known when the memory is full.
        """
        if len(self.known) >= CACHE:
            self.older, self.known = self.known, {}
        known, fresh = self.known, []
        for stretch in stretches:
            if stretch not in known:
                found = self.older.get(stretch)
                if found is None:
                    fresh.append(stretch)
                else:
                    known[stretch] = found
        for stretch, found in zip(fresh, self.merges.encode(fresh, LONG), strict=True):
            if found is None:
                found = np.array(encode_stretch(self.model, stretch), np.int32).T.tobytes()
            known[stretch] = found
        return [s for s in fresh if len(s) > CACHED_CHARS]

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids, begins and ends of all texts in a row, and where each text's ids begin in them."""
        found = [self.model.normalise(text or "") for text in texts]
        stretches = [self.model.chunks.findall(normal) for normal, _ in found]
        passing = self._learn(set().union(*stretches))
        pairs_of = self.known.__getitem__
        packed = [b"".join(map(pairs_of, own)) for own in stretches]
        for stretch in passing:
            del self.known[stretch]
        counts = np.array([len(p) // PAIR for p in packed], np.int64)
        pairs = np.frombuffer(b"".join(packed), np.int32).reshape(-1, 2)
        ids, sizes = pairs[:, 0], pairs[:, 1].astype(np.int64)
        owner = np.repeat(np.arange(len(texts)), counts)
        if not self.model.byte_fallback:
            ids, sizes, owner = _one_unknown(self.model, ids, sizes, owner)
            counts = np.bincount(owner, minlength=len(texts))
        # Each text has one place more than characters, for its end.
        ends = np.cumsum(sizes) + owner
        places = np.concatenate([begins for _, begins in found]).astype(np.int32)
        offsets = np.zeros(len(texts) + 1, np.int32)
        np.cumsum(counts, out=offsets[1:])
        return ids, places[ends - sizes], places[ends], offsets

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and per id the bytes of ``text`` where it begins and ends."""
        return self.encode_all([text])[:3]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """A worker's encoder, kept from task to task."""
    return Encoder(path)


def _one_unknown(model: Model, ids: np.ndarray, sizes: np.ndarray, owner: np.ndarray):
    """Unknown pieces in a row are one piece, across stretches too."""
    if not len(ids):
        return ids, sizes, owner
    first = np.ones(len(ids), bool)
    first[1:] = (ids[1:] != model.unknown) | (ids[:-1] != model.unknown) | (owner[1:] != owner[:-1])
    return ids[first], np.add.reduceat(sizes, np.flatnonzero(first)), owner[first]


def decode(model: Model, ids: list[int]) -> str:
    """The text of the ids: bytes that are no UTF-8 become U+FFFD one by one, the first added space goes."""
    types, surfaces = model.types, model.surfaces
    first = next((i for i in ids if types[i] != CONTROL), None)
    cut = 0
    if first is not None and types[first] not in (BYTE, UNKNOWN) and (model.dummy_space or model.strip_spaces):
        lead = surfaces[first]
        spaces = len(lead) - len(lead.lstrip(b" "))
        cut = spaces if model.strip_spaces else min(spaces, 1)
    if model.controls.isdisjoint(ids):
        with contextlib.suppress(UnicodeDecodeError):
            return b"".join(map(surfaces.__getitem__, ids))[cut:].decode()
    # Bytes on both sides of a control piece make no character together.
    runs: list[list[bytes]] = [[]]
    for i in ids:
        runs.append([]) if types[i] == CONTROL else runs[-1].append(surfaces[i])
    parts = [b"".join(run) for run in runs]
    begin = next((k for k, part in enumerate(parts) if part), 0)
    parts[begin] = parts[begin][cut:]
    return "".join(map(_decode_runs, parts))


def _decode_runs(raw: bytes) -> str:
    """Decodes and replaces each byte that belongs to no character."""
    made, at = [], 0
    while at < len(raw):
        try:
            made.append(raw[at:].decode())
            break
        except UnicodeDecodeError as wrong:
            made.append(raw[at : at + wrong.start].decode() + "�")
            at += wrong.start + 1
    return "".join(made)


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``SLICE`` characters each, at least one row."""
    begin = total = 0
    for i, size in enumerate(sizes):
        total += size
        if total >= SLICE:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(sizes):
        yield begin, len(sizes)


def encoded(text: Column, model_path: str, back: bool = False) -> Column:
    """``ids, begins, ends`` of each text, and with ``back`` the text ``decoded`` from the ids."""
    kind = "ids array<int>, begins array<int>, ends array<int>" + ", decoded string" * back

    @F.arrow_udf(kind)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(model_path)
        for texts in batches:
            sizes = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
            for begin, end in _slices(sizes):
                ids, begins, ends, offsets = own.encode_all(texts[begin:end].to_pylist())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(x))) for x in (ids, begins, ends)]
                names = ["ids", "begins", "ends"]
                if back:
                    flat = ids.tolist()
                    ranges = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
                    lists.append(pa.array([decode(own.model, flat[a:b]) for a, b in ranges], pa.string()))
                    names.append("decoded")
                yield pa.StructArray.from_arrays(lists, names)
            if not len(texts):
                yield pa.array([], pa.struct([(n, pa.list_(pa.int32())) for n in ("ids", "begins", "ends")] + [("decoded", pa.string())] * back))

    return of(text)


def decoded(ids: Column, model_path: str) -> Column:
    """The text of each list of ids; empty for null and empty lists."""

    @F.arrow_udf("string")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load(model_path)
        for lists in batches:
            yield pa.array(["" if x is None else decode(model, x) for x in lists.to_pylist()], pa.string())

    return of(ids)


def sentencepiece_encode(
    docs: DataFrame, model_path: str, text_column: str = "text", out: str = "pieces", back: bool = False
) -> DataFrame:
    """The rows and a struct ``out`` of ``ids, begins, ends``: begins and ends count bytes of the text.

    Ids are those of the sentencepiece library without begin, end or sampling.
    Null and empty texts have no ids. Of the byte pieces of one character the last
    spans it, the others span nothing. With ``back`` the struct also has the text
    ``decoded`` from the ids, in the same pass. Rows may repeat; an input column
    named like ``out`` is replaced; an empty table stays empty.
    """
    return docs.withColumn(out, encoded(F.col(f"`{text_column}`"), model_path, back))


def sentencepiece_decode(rows: DataFrame, model_path: str, ids: str = "pieces.ids", out: str = "decoded") -> DataFrame:
    """The rows and the text ``out`` of their ids, as the library's decode gives it."""
    return rows.withColumn(out, decoded(F.col(ids), model_path))
