import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wordflow.llm.lm import (
    FAN_IN,
    SIDES,
    SMOOTH,
    Network,
    Shape,
    _band,
    _mean,
    _task_network,
    bands,
    corpus_chunks,
    lm_scores,
    scored_texts,
    train,
)


def pairs(seed, n):
    """Texts in which a word tells the next one."""
    rng = random.Random(seed)
    heads = [f"head{i}" for i in range(30)]
    return [
        (i, " ".join(f"{h} tail{h[4:]}" for h in rng.choices(heads, k=rng.randint(20, 60)))) for i in range(n)
    ]


def hashed(text):
    return [xxhash.xxh64_intdigest(w) for w in (text or "").encode().lower().split()]


def brute_scores(texts, tables, network):
    """Every word by itself, in plain Python, from counts made anew."""
    shape = tables.shape
    counts = Counter(w for t in texts for w in hashed(t))
    cell = {w: (int(tables.kinds[bands(np.array([n]))[0]]), (w >> 40) % shape.classes) for w, n in counts.items()}
    in_cell, different = Counter(), Counter()
    for w, n in counts.items():
        in_cell[cell[w]] += n
        different[cell[w]] += 1

    def log_softmax(vectors, offsets, hidden, at):
        scores = [float(np.dot(v.astype(float), hidden)) + float(o) for v, o in zip(vectors, offsets, strict=True)]
        return scores[at] - math.log(sum(map(math.exp, scores)))

    found = []
    for text in texts:
        words, total = hashed(text), 0.0
        for i, w in enumerate(words):
            hidden = np.zeros(network.words.shape[1])
            for s, side in enumerate(SIDES):
                j = i + side
                near = words[j] % shape.buckets if 0 <= j < len(words) else shape.buckets
                hidden += network.words[near].astype(float) * network.sides[s]
            hidden = np.tanh(hidden)
            kind, slot = cell[w]
            total += log_softmax(network.classes, network.offsets, hidden, kind)
            total += log_softmax(network.slots[kind], network.slot_offsets[kind], hidden, slot)
            # The hidden occurrence itself is not counted.
            total += math.log((counts[w] - 1 + SMOOTH) / (in_cell[kind, slot] - 1 + SMOOTH * different[kind, slot]))
        found.append(total)
    return found


def rows_of(spark, rows, parts=3):
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts, "doc_id")


def keyed(frame):
    return frame.select(F.col("doc_id").cast("string").alias("key"), F.coalesce("text", F.lit("")).alias("text"))


@pytest.mark.parametrize("chunk", [1 << 20, 300])
def test_scores_are_those_of_every_word_by_itself(spark, texts, monkeypatch, chunk):
    monkeypatch.setattr("wordflow.llm.lm.CHUNK", chunk)
    rows = pairs(1, 40) + [(100 + i, t) for i, (_, t, *_) in enumerate(texts) if len(t or "") < 5000]
    frame = rows_of(spark, rows)
    counted, tables = corpus_chunks(keyed(frame))
    network = train(counted, tables)
    wanted = dict(zip((str(r[0]) for r in rows), brute_scores([t for _, t in rows], tables, network), strict=True))
    got = {r.key: r.log_likelihood for r in scored_texts(counted, tables, network).collect()}
    assert got.keys() == wanted.keys()
    assert all(math.isclose(got[k], wanted[k], rel_tol=1e-4, abs_tol=1e-3) for k in got)


def test_the_query_s_operator_uses_that_model(spark):
    frame = rows_of(spark, pairs(1, 40))
    texts = frame.select(F.md5("text").alias("key"), "text")
    counted, tables = corpus_chunks(texts)
    want = {r.key: r.log_likelihood for r in scored_texts(counted, tables, train(counted, tables)).collect()}
    got = lm_scores(frame).withColumn("key", F.md5("text")).collect()
    assert len(got) == 40 and all(math.isclose(r.log_likelihood, want[r.key], rel_tol=1e-9) for r in got)


def test_probabilities_of_all_words_sum_to_one(spark):
    frame = rows_of(spark, pairs(3, 30) + [(99, "only here once")])
    counted, tables = corpus_chunks(keyed(frame))
    network = train(counted, tables)
    shape = tables.shape
    around = np.array([[1, 2, 3, shape.buckets]], np.int32)
    vocabulary = Counter(w for r in frame.collect() for w in hashed(r.text))
    words = np.array([(w >> 40 & 255) << 23 | w & (1 << 23) - 1 for w in vocabulary], np.int32)
    counts = np.array(list(vocabulary.values()), np.int64)
    kinds, slots = tables.class_of(counts), shape.slots(words)
    levels = network.log_probabilities(kinds, slots, np.repeat(around, len(words), axis=0))
    # Without one occurrence of the hidden word: the others have their whole counts.
    for hidden in range(0, len(words), 7):
        cell = (kinds == kinds[hidden]) & (slots == slots[hidden])
        whole = counts[cell] + SMOOTH - (np.flatnonzero(cell) == hidden)
        share = whole / (tables.all[kinds[hidden], slots[hidden]] - 1 + SMOOTH * cell.sum())
        assert math.isclose(share.sum(), 1)
    every = network.log_probabilities(
        np.repeat(np.arange(shape.classes), shape.classes), np.tile(np.arange(shape.classes), shape.classes),
        np.repeat(around, shape.classes**2, axis=0),
    )
    assert math.isclose(np.exp(every).sum(), 1, rel_tol=1e-6)
    assert np.isfinite(levels).all()


def held_out(spark, seed, shuffled):
    """Mean log-probabilities of texts beside a corpus like them."""
    rng = random.Random(seed)
    rows = pairs(1, 1500)
    held = [(10_000 + i, t) for i, t in pairs(seed, 60)]
    mixed = [(20_000 + i, " ".join(rng.sample(t.split(), len(t.split())))) for i, (_, t) in enumerate(held)]
    found = lm_scores(rows_of(spark, rows + held + (mixed if shuffled else []))).collect()
    return {r.doc_id: r.per_token for r in found}


def test_shuffled_words_are_less_likely(spark, monkeypatch):
    monkeypatch.setattr("wordflow.llm.lm.CHUNK", 4000)
    monkeypatch.setattr("wordflow.llm.lm.BATCH", 256)
    got = held_out(spark, 4, True)
    better = [got[10_000 + i] > got[20_000 + i] for i in range(60)]
    assert sum(better) > 54


def test_training_helps(spark, monkeypatch):
    monkeypatch.setattr("wordflow.llm.lm.CHUNK", 4000)
    monkeypatch.setattr("wordflow.llm.lm.BATCH", 256)
    trained = held_out(spark, 6, False)
    monkeypatch.setattr("wordflow.llm.lm.train", lambda counted, tables: Network.start(tables.shape))
    start = held_out(spark, 6, False)
    held = [i for i in trained if i >= 10_000]
    assert sum(trained[i] for i in held) / len(held) > sum(start[i] for i in held) / len(held) + 0.3


def test_given_documents(spark, docs, texts, no_docs):
    rows = lm_scores(docs.repartition(3)).collect()
    assert len(rows) == len(texts) and {r.made for r in rows} == {"own made"}
    for r in rows:
        n = len(hashed(r.text))
        assert r.n_tokens == n
        if n:
            assert r.log_likelihood < 0 and math.isclose(r.per_token, r.log_likelihood / n)
        else:
            assert r.log_likelihood == 0 and r.per_token is None
    assert len({r.log_likelihood for r in rows if r.doc_id in (1, 2)}) == 1
    assert lm_scores(no_docs).count() == 0


def test_a_word_found_once_is_not_foretold_by_itself(spark):
    rows = pairs(1, 200) + [(1000, "head1 junkjunk tail2"), (1001, "head1 tail1 head2")]
    got = {r.doc_id: r.per_token for r in lm_scores(rows_of(spark, rows)).collect()}
    assert got[1000] < got[1001] - 1


def test_networks_are_averaged_in_a_tree(spark):
    shape = Shape(8, 2)
    n = 2 * FAN_IN + 5
    networks, total = [], 0.0
    rng = np.random.default_rng(1)
    for task in range(n):
        network = Network.start(shape)
        network.classes = rng.normal(size=network.classes.shape).astype(np.float32)
        networks.append(_task_network(task, task + 1, network))
        total = total + network.pack().astype(np.float64) * (task + 1)
    parts = spark.createDataFrame([tuple(r) for f in networks for r in f.itertuples(index=False)], "task bigint, n double, weights binary")
    mean = _mean(parts, Network.start(shape))
    assert np.allclose(mean.pack(), total / (n * (n + 1) / 2), atol=1e-4)


def test_what_is_gathered_grows_with_the_corpus(spark):
    sizes = []
    for n in (100, 30_000):
        frame = spark.createDataFrame([(str(i), f"A{i} a") for i in range(n)], "key string, text string").repartition(3)
        _, tables = corpus_chunks(frame)
        assert tables.different.sum() == n + 1 and tables.all.sum() == 2 * n
        sizes.append((tables.shape.buckets, tables.shape.classes))
    assert sizes[0] < sizes[1] and sizes[0][1] < sizes[1][1]
    assert Shape.of(10**8) == Shape(1 << 14, 1 << 4) and Shape.of(10**13) == Shape(1 << 20, 1 << 6)


def test_bands_are_the_same_on_both_sides(spark):
    counts = [1, 2, 31, 32, 63, 64, 65, 127, 128, 1000, 10**6, 10**12, 2**52 + 1]
    frame = spark.createDataFrame([(n,) for n in counts], "n bigint")
    got = {r.n: r.band for r in frame.select("n", _band(F.col("n")).alias("band")).collect()}
    assert [got[n] for n in counts] == bands(np.array(counts)).tolist() == sorted(got.values())
