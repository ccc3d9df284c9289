import random
from collections import Counter

import numpy as np
import pytest

from wordflow.llm import repeats
from wordflow.llm.repeats import anchors, leftmost_least, remove_repeats


def brute(texts, length):
    counts = Counter(raw[i : i + length] for raw in texts for i in range(len(raw) - length + 1))
    for raw in texts:
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if counts[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        yield kept, len(raw), int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())


def check(frame, length, gram):
    rows = frame.collect()
    wanted = Counter(
        zip([r.doc_id for r in rows], brute([(r.text or "").encode() for r in rows], length), strict=True)
    )
    found = remove_repeats(frame, length=length, gram=gram).collect()
    assert Counter((r.doc_id, (bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans)) for r in found) == wanted
    return found


def test_leftmost_of_the_least():
    rng = np.random.default_rng(1)
    for _ in range(100):
        n = int(rng.integers(1, 120))
        width = int(rng.integers(1, n + 1))
        values = rng.integers(0, 5, n).astype(np.uint64)
        assert leftmost_least(values, width).tolist() == [
            i + int(np.argmin(values[i : i + width])) for i in range(n - width + 1)
        ]


def test_anchors_cover_every_window():
    raw = bytes(np.random.default_rng(2).integers(97, 110, 3000, np.uint8))
    for at, lo, hi, _, _ in anchors(raw, 100, 20):
        covered = np.concatenate([np.arange(a, b + 1) for a, b in zip(lo, hi, strict=True)])
        assert covered.tolist() == list(range(len(raw) - 99))
        assert ((lo <= at) & (at + 20 <= hi + 100)).all()


def pieces(seed, docs=60):
    """Texts out of shared and own pieces, of all lengths around the threshold."""
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared = [word(rng.randint(5, 60)) for _ in range(8)] + ["ab" * 40, "a" * 90]
    made = []
    for i in range(docs):
        parts = [rng.choice(shared) if rng.random() < 0.6 else word(rng.randint(1, 40)) for _ in range(rng.randint(0, 9))]
        made.append((i, "".join(parts)))
    return [*made, made[3], (1000, None), (None, shared[0] * 2), (None, "")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_same_as_brute_force(spark, seed):
    frame = spark.createDataFrame(pieces(seed), "doc_id bigint, text string")
    found = check(frame, 30, 8)
    assert any(0 < r.n_removed < r.n_bytes for r in found)


def test_grams_with_many_texts_are_dealt_by_window(spark, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP", 2)
    check(spark.createDataFrame(pieces(4), "doc_id bigint, text string"), 30, 8)


def test_long_texts_are_looked_at_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 50)
    raw = pieces(5)
    whole = anchors("".join(t or "" for _, t in raw).encode(), 30, 8)
    covered = np.concatenate([np.arange(a, b + 1) for _, lo, hi, _, _ in whole for a, b in zip(lo, hi, strict=True)])
    assert covered.tolist() == list(range(len(covered)))


def test_given_documents(docs, texts):
    found = check(docs, 200, 48)
    assert len(found) == len(texts)
    assert {r.doc for r in found} == {"own doc"}


def test_empty_table(no_docs):
    assert remove_repeats(no_docs).count() == 0


def test_rows_that_repeat_often(spark):
    rows = pieces(6, docs=12)
    check(spark.createDataFrame(rows + rows[:5] * 40, "doc_id bigint, text string").repartition(5), 30, 8)
