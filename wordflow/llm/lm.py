"""Masked pseudo-likelihood of documents: every word is hidden in turn and predicted from both sides.

A small window network in numpy reads two words on either side and gives a
two-level softmax: the word's class, then its slot within the class. Classes are
bands of frequency, slots are parts of a class by the words' hashes, so both levels
are learned from context. Within its slot a word has its share of the corpus,
counted without the hidden occurrence itself. The number of classes, of slots and
of neighbours that the network tells apart grows with the corpus, as does the table
of words, which are counted by a shuffle.

Texts are put into chunks, and a chunk sends each of its words to be counted once,
so what is shuffled are distinct words, not places. Training runs through all
chunks once, in rounds that double: each task starts at the mean network of the
round before and goes through its own chunks, and the networks are averaged by
their numbers of words, in a tree, so that no task or driver holds more than a few.

A word is known by 64 bits of its hash: of a billion different words, 0.03 pairs
are expected to meet.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordflow.llm.common import discard, packed, unpacked, written

SIDES = (-2, -1, 1, 2)
WIDTH = 8
RATE = 0.5
BATCH = 1 << 14
# A class with fewer words in a batch moves its slots as if it had so many.
LEAST_SHARE = 32
# Networks that are added up together.
FAN_IN = 16
# Words of a chunk, which sends each distinct one to be counted.
CHUNK = 1 << 20
# Chunks of the first round of training; rounds double from there.
FIRST_ROUND = 8
# Of a word's hash, the bits that give its bucket and, from ``SLOT_SHIFT`` on, its slot:
# more than a shape has for 10 ** 16 words. Side by side they are the word's code.
BUCKET_BITS, SLOT_SHIFT, SLOT_BITS = 23, 40, 8
# Every word of a slot counts as if it stood there so much more often.
SMOOTH = 0.5
# Counts with the same leading bits share a class.
LEADING_BITS = 6
# Scores are kept within this, where powers of e are ordinary numbers.
HIGHEST = np.float32(60.0)
RESULTS = ["n_tokens", "log_likelihood", "per_token"]


@dataclass(frozen=True)
class Shape:
    """Sizes of a network: ``buckets`` of neighbours, ``classes``, and as many slots in each class.

    They grow as the third and the eighth root of the words of the corpus: 16
    thousand and 16 for a hundred million words, a million and 64 for ten million
    million, where a network takes 34 MB.
    """

    buckets: int
    classes: int

    @classmethod
    def of(cls, words: int) -> Shape:
        bits = max(1, words).bit_length()
        return cls(1 << 5 + -(-bits // 3), 1 << -(-bits // 8))

    def arrays(self) -> list[tuple[int, ...]]:
        k = self.classes
        return [(self.buckets + 1, WIDTH), (len(SIDES), WIDTH), (k, WIDTH), (k,), (k, k, WIDTH), (k, k)]

    def neighbours(self, texts: list[np.ndarray]) -> np.ndarray:
        """Per word of all texts in a row the buckets on both sides; the last bucket is the edge of a text."""
        edge = np.full(max(SIDES), self.buckets, np.int32)
        parts = [edge]
        for text in texts:
            parts += [text & np.int32(self.buckets - 1), edge]
        line = np.concatenate(parts)
        return line[np.flatnonzero(line != self.buckets)[:, None] + np.array(SIDES)]

    def slots(self, codes: np.ndarray) -> np.ndarray:
        """The slot of each word, by bits of its hash that no bucket looks at."""
        return (codes >> BUCKET_BITS & np.int32(self.classes - 1)).astype(np.int64)


def _exp(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the scores, which stay far from overflow, and their sums per row."""
    powers = np.exp(np.clip(scores, -HIGHEST, HIGHEST, out=scores))
    return powers, powers @ np.ones(powers.shape[1], powers.dtype)


def _cells(scores: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each row's wanted score lies in the flat array."""
    return np.arange(0, scores.size, scores.shape[1]) + wanted


def _wrong(scores: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The softmax of each row, less one where it is wanted: the slope of the loss."""
    powers, sums = _exp(scores)
    powers /= sums[:, None]
    powers.reshape(-1)[_cells(powers, wanted)] -= 1
    return powers


def _log_chosen(scores: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The logarithm of each row's softmax where it is wanted."""
    _, sums = _exp(scores)
    return scores.reshape(-1).take(_cells(scores, wanted)).astype(np.float64) - np.log(sums.astype(np.float64))


def _by_class(kinds: np.ndarray, classes: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each class, and the places where it is wanted."""
    order = np.argsort(kinds.astype(np.min_scalar_type(classes)), kind="stable")
    ends = np.cumsum(np.bincount(kinds, minlength=classes)).tolist()
    for kind, (begin, end) in enumerate(zip([0, *ends], ends)):
        if begin < end:
            yield kind, order[begin:end]


@dataclass
class Network:
    """Weights: neighbours' vectors, a scale per side, and the vectors and offsets of classes and slots."""

    shape: Shape
    words: np.ndarray
    sides: np.ndarray
    classes: np.ndarray
    offsets: np.ndarray
    slots: np.ndarray
    slot_offsets: np.ndarray

    @classmethod
    def start(cls, shape: Shape) -> Network:
        rng = np.random.default_rng(11)
        words, sides, classes, offsets, slots, slot_offsets = shape.arrays()
        return cls(
            shape,
            rng.normal(0, 0.3, words).astype(np.float32),
            np.full(sides, 1 / len(SIDES), np.float32),
            rng.normal(0, 0.3, classes).astype(np.float32),
            np.zeros(offsets, np.float32),
            np.zeros(slots, np.float32),
            np.zeros(slot_offsets, np.float32),
        )

    def pack(self) -> np.ndarray:
        weights = self.words, self.sides, self.classes, self.offsets, self.slots, self.slot_offsets
        return np.concatenate([w.ravel() for w in weights])

    @classmethod
    def unpack(cls, shape: Shape, flat: np.ndarray) -> Network:
        parts, at = [], 0
        for size in shape.arrays():
            n = int(np.prod(size))
            parts.append(flat[at : at + n].reshape(size).astype(np.float32))
            at += n
        return cls(shape, *parts)

    def hidden(self, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        near = self.words.take(around, axis=0)
        return near, np.tanh(np.einsum("nsw,sw->nw", near, self.sides))

    def log_probabilities(self, kinds: np.ndarray, slots: np.ndarray, around: np.ndarray) -> np.ndarray:
        """Of the wanted classes and slots, each given its neighbours."""
        _, hidden = self.hidden(around)
        found = _log_chosen(hidden @ self.classes.T + self.offsets, kinds)
        for kind, rows in _by_class(kinds, len(self.classes)):
            found[rows] += _log_chosen(hidden.take(rows, axis=0) @ self.slots[kind].T + self.slot_offsets[kind], slots.take(rows))
        return found

    def learn(self, kinds: np.ndarray, slots: np.ndarray, around: np.ndarray) -> None:
        """One step of gradient descent on a batch, through both levels."""
        near, hidden = self.hidden(around)
        rate = np.float32(RATE / len(kinds))
        wrong = _wrong(hidden @ self.classes.T + self.offsets, kinds)
        back = wrong @ self.classes
        for kind, rows in _by_class(kinds, len(self.classes)):
            own = hidden.take(rows, axis=0)
            inside = _wrong(own @ self.slots[kind].T + self.slot_offsets[kind], slots.take(rows))
            back[rows] += inside @ self.slots[kind]
            share = np.float32(RATE / max(len(rows), LEAST_SHARE))
            self.slots[kind] -= share * (inside.T @ own)
            self.slot_offsets[kind] -= share * inside.sum(axis=0)
        back *= 1 - hidden * hidden
        self.classes -= rate * (wrong.T @ hidden)
        self.offsets -= rate * wrong.sum(axis=0)
        # A word's vector moves by the mean over its places, so frequent words don't run away.
        moves = back[:, None, :] * self.sides
        self.sides -= rate * np.einsum("nw,nsw->sw", back, near)
        flat, moves = around.ravel(), moves.reshape(-1, WIDTH)
        seen = np.bincount(flat, minlength=len(self.words))
        met = np.flatnonzero(seen)
        sums = np.stack([np.bincount(flat, moves[:, k], len(seen))[met] for k in range(WIDTH)], axis=1)
        self.words[met] -= (RATE * sums / seen[met, None]).astype(np.float32)


CHUNKS = "chunk bigint, keys array<string>, sizes array<int>, words array<bigint>, n array<int>, places binary"


def _chunks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts of about ``CHUNK`` words as places in the list of their distinct words."""
    keys: list[str] = []
    sizes: list[int] = []
    places: list[int] = []
    known: defaultdict[bytes, int] = defaultdict(count().__next__)
    # Numbered by task and turn, the same whenever the task runs.
    numbers = count(TaskContext.get().partitionId() << 32)

    def made() -> pd.DataFrame:
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known)).view(np.int64)
        at = np.array(places, np.int64)
        n = np.bincount(at, minlength=len(known))
        # Frequent words first: their places are small numbers, which are packed well.
        order = np.argsort(-n, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        row = next(numbers), keys, sizes, hashes[order], n[order], _zipped(rank[at])
        return pd.DataFrame([row], columns=["chunk", "keys", "sizes", "words", "n", "places"])

    for frame in frames:
        for key, text in zip(frame["key"], frame["text"], strict=True):
            words = text.encode().lower().split() if text else []
            keys.append(key)
            sizes.append(len(words))
            places.extend(map(known.__getitem__, words))
            if len(places) >= CHUNK:
                yield made()
                keys, sizes, places, known = [], [], [], defaultdict(count().__next__)
    if keys:
        yield made()


def _zipped(numbers: np.ndarray) -> bytes:
    """Numbers under 2 ** 32, byte by byte: the upper ones are mostly alike."""
    return zlib.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unzipped(data: bytes) -> np.ndarray:
    parts = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(parts.T).view("<u4").ravel().astype(np.int64)


def _slot(word: Column) -> Column:
    return F.shiftrightunsigned(word, SLOT_SHIFT).bitwiseAND(F.lit((1 << SLOT_BITS) - 1)).cast("int")


def _code(word: Column) -> Column:
    bucket = word.bitwiseAND(F.lit((1 << BUCKET_BITS) - 1)).cast("int")
    return F.call_function("shiftleft", _slot(word), F.lit(BUCKET_BITS)).bitwiseOR(bucket)


def counted_words(chunks: DataFrame) -> DataFrame:
    """``chunk, at, all, slot`` per word of a chunk's list: its place there, and how often the corpus has it; stored.

    ``slot``, the bits that give a word's slot, is there in one of its rows only, so
    that these rows are the vocabulary. A word is in a chunk's list once, so however
    frequent it is, its rows are a tiny share of all that are shuffled.
    """
    listed = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "n")).alias("at", "w"))
    of_word = Window.partitionBy("word")
    slot = _slot(F.col("word"))
    found = listed.select("chunk", "at", F.col("w.words").alias("word"), F.col("w.n").alias("n")).select(
        "chunk",
        "at",
        F.sum("n").over(of_word).alias("all"),
        F.when(F.min("chunk").over(of_word) == F.col("chunk"), slot).alias("slot"),
    )
    return written(found, "counted")


def _band(n: Column) -> Column:
    """A number that grows with a count: as many of its leading bits as tell classes apart."""
    spare = F.greatest(F.length(F.bin(n)) - LEADING_BITS, F.lit(0))
    return (spare * (1 << LEADING_BITS - 1) + F.call_function("shiftright", n, spare)).cast("int")


def bands(n: np.ndarray) -> np.ndarray:
    spare = np.maximum(np.frexp(n.astype(np.float64))[1] - LEADING_BITS, 0)
    return spare * (1 << LEADING_BITS - 1) + (n >> spare)


@dataclass
class Tables:
    """What the in-slot step knows of the corpus, and the class of each band of counts."""

    shape: Shape
    kinds: np.ndarray
    #: Words in the corpus, and different words, per class and slot.
    all: np.ndarray
    different: np.ndarray

    @classmethod
    def of(cls, counted: DataFrame) -> Tables:
        """From ``counted_words``. Classes hold about equal shares of the corpus, from frequent to rare.

        The driver gets a row per band, 2,000 at most, and one per class and slot.
        """
        vocabulary = counted.filter(F.col("slot").isNotNull())
        found = vocabulary.groupBy(_band(F.col("all")).alias("band")).agg(F.sum("all").alias("n")).collect()
        weight = np.zeros(max((r["band"] for r in found), default=0) + 1, np.float64)
        for r in found:
            weight[r["band"]] = r["n"]
        shape = Shape.of(int(weight.sum()))
        falling = weight[::-1]
        before = np.cumsum(falling) - falling
        share = np.minimum(shape.classes - 1, before * shape.classes / max(1.0, weight.sum())).astype(np.int64)
        kinds = share[::-1].copy()
        slot = F.col("slot").bitwiseAND(F.lit(shape.classes - 1))
        kind = F.get(F.array(*[F.lit(int(k)) for k in kinds]), _band(F.col("all")))
        cells = vocabulary.groupBy(kind.alias("kind"), slot.alias("slot")).agg(
            F.sum("all").alias("n"), F.count("*").alias("different")
        )
        made = cls(shape, kinds, *(np.zeros((shape.classes, shape.classes)) for _ in range(2)))
        for kind_, slot_, n, different in cells.collect():
            made.all[kind_, slot_], made.different[kind_, slot_] = n, different
        return made

    def class_of(self, counts: np.ndarray) -> np.ndarray:
        return self.kinds[bands(counts)]

    def log_shares(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Of words in their slots, in a corpus without the one place where each is hidden."""
        cell = self.class_of(counts), self.shape.slots(codes)
        return np.log((counts - 1 + SMOOTH) / (self.all[cell] - 1 + SMOOTH * self.different[cell]))


def _with_counts(chunk: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
    """A chunk and the counts of its words, in the order of its list."""
    all_ = np.zeros(len(counted), np.int64)
    all_[counted["at"].to_numpy()] = counted["all"].to_numpy()
    return chunk.assign(all=[all_])


READY = "chunk bigint, keys array<string>, sizes array<int>, places binary, codes array<int>, turn int, all array<bigint>"


def with_counts(chunks: DataFrame, counted: DataFrame) -> DataFrame:
    """The chunks with the counts of their words in the corpus, and a round of training. A group is one chunk."""
    rank = F.pmod(F.xxhash64("chunk"), F.lit(max(1, chunks.count())))
    turn = (F.floor(F.log2(F.greatest(rank / FIRST_ROUND, F.lit(0.5)))) + 1).cast("int")
    codes = F.transform("words", _code).alias("codes")
    left = chunks.select("chunk", "keys", "sizes", "places", codes, turn.alias("turn")).groupBy("chunk")
    return left.cogroup(counted.select("chunk", "at", "all").groupBy("chunk")).applyInPandas(_with_counts, READY)


def _read(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's places in its list of words, the codes of these words, and their counts in the corpus."""
    return _unzipped(row.places), row.codes, row.all


def _texts(row, places: np.ndarray, codes: np.ndarray) -> list[np.ndarray]:
    return np.split(codes[places], np.cumsum(row.sizes)[:-1])


PARTS = "task bigint, n double, weights binary"


def _task_network(task: int, n: int, network: Network) -> pd.DataFrame:
    whole = network.pack().astype(np.float64) * n
    return pd.DataFrame({"task": [task], "n": [float(n)], "weights": [whole.astype(np.float32).tobytes()]})


def _add(frame: pd.DataFrame) -> pd.DataFrame:
    ordered = frame.sort_values("task")
    total = sum(np.frombuffer(weights, np.float32).astype(np.float64) for weights in ordered["weights"])
    made = {"task": [int(ordered["task"].iloc[0]) // FAN_IN], "n": [ordered["n"].sum()]}
    return pd.DataFrame({**made, "weights": [total.astype(np.float32).tobytes()]})


def _mean(parts: DataFrame, otherwise: Network) -> Network:
    """The mean of the tasks' networks, weighted by their words."""
    parts = written(parts, "networks")
    n = parts.count()
    while n > 1:
        grouped = parts.groupBy((F.col("task") / FAN_IN).cast("bigint").alias("group"))
        before, parts = parts, written(grouped.applyInPandas(_add, PARTS), "networks")
        discard(before)
        n = parts.count()
    row = parts.first()
    discard(parts)
    if row is None:
        return otherwise
    return Network.unpack(otherwise.shape, np.frombuffer(bytes(row["weights"]), np.float32) / row["n"])


def train(ready: DataFrame, tables: Tables) -> Network:
    """Passes the mean network from round to round; every chunk has its turn once.

    The first one knows the shares of classes and slots in the corpus.
    """
    shape = tables.shape
    network = Network.start(shape)
    per_class = tables.all.sum(axis=1) + 1
    network.offsets = np.log(per_class / per_class.sum()).astype(np.float32)
    network.slot_offsets = np.log((tables.all + 1) / (tables.all + 1).sum(axis=1, keepdims=True)).astype(np.float32)
    task = F.spark_partition_id().cast("bigint").alias("task")
    columns = ["sizes", "codes", "places", "all"]
    for turn in sorted(r["turn"] for r in ready.select("turn").distinct().collect()):
        shared = ready.sparkSession.sparkContext.broadcast((tables, network.pack()))

        def run(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            known, start = shared.value
            own, n, task = Network.unpack(known.shape, start), 0, 0
            for frame in frames:
                for row in frame.itertuples():
                    places, codes, counts = _read(row)
                    around = known.shape.neighbours(_texts(row, places, codes))
                    kinds, slots = known.class_of(counts)[places], known.shape.slots(codes)[places]
                    for begin in range(0, len(places), BATCH):
                        part = slice(begin, begin + BATCH)
                        own.learn(kinds[part], slots[part], around[part])
                    n, task = n + len(places), row.task
            if n:
                yield _task_network(task, n, own)

        part = ready.filter(F.col("turn") == turn).select(*columns, task)
        network = _mean(part.mapInPandas(run, PARTS), network)
        shared.unpersist()
    return network


def scored_texts(ready: DataFrame, tables: Tables, network: Network) -> DataFrame:
    """``key, n_tokens, log_likelihood`` per text: the sum over its words, each hidden in turn."""
    shared = ready.sparkSession.sparkContext.broadcast((tables, network.pack()))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, weights = shared.value
        own = Network.unpack(known.shape, weights)
        for frame in frames:
            for row in frame.itertuples():
                places, codes, counts = _read(row)
                around = known.shape.neighbours(_texts(row, places, codes))
                kinds, slots = known.class_of(counts)[places], known.shape.slots(codes)[places]
                found = known.log_shares(codes, counts)[places]
                for begin in range(0, len(places), BATCH):
                    part = slice(begin, begin + BATCH)
                    found[part] += own.log_probabilities(kinds[part], slots[part], around[part])
                owner = np.repeat(np.arange(len(row.sizes)), row.sizes)
                sums = np.bincount(owner, found, len(row.sizes))
                yield pd.DataFrame({"key": row.keys, "n_tokens": row.sizes, "log_likelihood": sums})

    return ready.mapInPandas(run, "key string, n_tokens bigint, log_likelihood double")


def corpus_chunks(texts: DataFrame) -> tuple[DataFrame, Tables]:
    """The chunks of ``key, text`` rows with the counts of their words, stored, and the tables of the corpus."""
    chunks = written(texts.mapInPandas(_chunks, CHUNKS), "chunks")
    counted = counted_words(chunks)
    tables = Tables.of(counted)
    ready = written(with_counts(chunks, counted), "ready")
    discard(chunks)
    discard(counted)
    return ready, tables


def lm_scores(
    docs: DataFrame, text_column: str = "text", carry: DataFrame | None = None
) -> DataFrame:
    """The rows with ``n_tokens``, ``log_likelihood`` and ``per_token``.

    ``log_likelihood`` is the sum over the text's words of the logarithm of the
    probability of a word given up to two on either side; ``per_token`` its mean,
    null for texts without words, whose sum is 0. Null texts have no words. A-Z is
    lowered. Repeated rows count as often as they stand there and get the same
    score. ``carry`` (a selection of ``docs``) says which columns come back, those
    named like results replaced. An empty table stays empty.

    The network is the same for the same rows in the same partitions.
    """
    carried = docs if carry is None else carry
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    # What a text scores depends on the text only, so its digest finds its row again.
    rows = written(docs.select(packed(carried), F.md5(text).alias("key")), "rows")
    ready, tables = corpus_chunks(docs.select(F.md5(text).alias("key"), text.alias("text")))
    scored = scored_texts(ready, tables, train(ready, tables))
    once = written(scored.groupBy("key").agg(F.max(F.struct("n_tokens", "log_likelihood")).alias("s")), "scored")
    discard(ready)
    made = rows.join(once, "key").select("row", "s.*")
    per_token = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return made.select("row", "n_tokens", "log_likelihood", per_token.alias("per_token")).select(
        unpacked(carried.columns, RESULTS)
    )
