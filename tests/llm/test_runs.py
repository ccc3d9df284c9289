import hashlib
import random
import zlib

import numpy as np
import pytest

from wordflow.llm.queries import QUERIES, planted
from wordflow.llm.runs import Extensions, Texts, periodic_runs, runs_of, without_repeats

SF_DIR = "/root/testdata/sf0.001"


def brute_runs(words):
    """All periods from the smallest, all stretches of equal words that far apart."""
    n, seen = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                seen.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((s, e - s, q) for (s, e), q in seen.items())


def brute_collapsed(words):
    gone = {i for s, size, q in brute_runs(words) for i in range(s + q, s + size)}
    return [w for i, w in enumerate(words) if i not in gone]


def made(rng):
    kind = rng.randrange(5)
    if kind == 0:
        return [rng.choice("ab") for _ in range(rng.randrange(60))]
    if kind == 1:
        return [rng.choice("abc") for _ in range(rng.randrange(4))] * rng.randrange(20)
    words = [rng.choice("abcdefgh") for _ in range(rng.randrange(50))]
    if kind >= 3:
        at, q = rng.randrange(len(words) + 1), rng.randrange(1, 9)
        words[at:at] = [rng.choice("abcd") for _ in range(q)] * rng.randrange(3, 9)
    if kind == 4:
        words = words * 5
    return words


@pytest.mark.parametrize("seed", range(20))
def test_runs_of_random_texts(seed):
    rng = random.Random(seed)
    texts = [[w.encode() for w in made(rng)] for _ in range(60)]
    found = runs_of(texts)
    for words, runs in zip(texts, found, strict=True):
        assert [tuple(r) for r in runs.tolist()] == brute_runs(words)
        assert without_repeats(words, runs) == brute_collapsed(words)


def test_extensions_are_exact():
    rng = random.Random(1)
    texts = Texts([np.array([rng.choice((0, 0, 0, 1)) for _ in range(rng.randrange(1, 90))]) for _ in range(30)])
    ahead = Extensions(texts.line, texts.owner)
    a, b, wanted = [], [], []
    for begin, size in zip(texts.begins, texts.sizes, strict=True):
        for _ in range(40):
            i, j = (int(begin + rng.randrange(size)) for _ in range(2))
            if i != j:
                n = 0
                while texts.line[i + n] == texts.line[j + n]:
                    n += 1
                a, b, wanted = [*a, i], [*b, j], [*wanted, n]
    assert ahead(np.array(a), np.array(b)).tolist() == wanted


def test_small_blocks_find_the_same(monkeypatch):
    rng = random.Random(9)
    texts = [[w.encode() for w in made(rng)] for _ in range(50)] + [[b"x"] * 3000, [b"x", b"y"] * 900]
    whole = [r.tolist() for r in runs_of(texts)]
    monkeypatch.setattr("wordflow.llm.runs.PAIRS", 37)
    assert [r.tolist() for r in runs_of(texts)] == whole
    assert whole[-2:] == [[[0, 3000, 1]], [[0, 1800, 2]]]


def test_rows(spark, docs, no_docs):
    rows = periodic_runs(docs).collect()
    assert len(rows) == docs.count() and {r.fp for r in rows} == {"own fp"}
    by = {r.doc_id: r for r in rows}
    for r in rows:
        words = (r.text or "").encode().split()
        if len(words) < 500:
            assert [(x.start, x.length, x.period) for x in r.runs] == brute_runs(words)
            assert r.collapsed == b" ".join(brute_collapsed(words)).decode()
            assert r.n_runs == len(r.runs)
    # Six times the same eight words.
    assert [(x.start, x.length, x.period) for x in by[14].runs] == [(0, 48, 8)]
    assert by[4].collapsed == by[5].collapsed == by[6].collapsed == ""
    assert by[10].n_runs == 0
    clash = periodic_runs(docs.withColumnRenamed("lang", "runs"))
    assert clash.columns.count("runs") == 1
    assert periodic_runs(no_docs).count() == 0


def brute_planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_query(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SF_DIR).collect()}
    assert len(got) == len(documents)
    some = 0
    for doc_id, text in documents:
        words = brute_planted(doc_id, (text or "").encode().split())
        if len(words) > 1500:
            continue
        runs = brute_runs(words)
        lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
        r = got[doc_id]
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(brute_collapsed(words))).hexdigest()
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        told = (r.start, r.length, r.period, r.exponent_milli)
        assert told == ((None,) * 4 if best is None else (*best, 1000 * best[1] // best[2]))
        some += bool(runs)
    assert some > 5


def test_planting_leaves_rows_without_an_id(spark):
    rows = spark.createDataFrame([(None, "a  b"), (7, None), (8, "")], "doc_id bigint, text string")
    got = [r[0] for r in rows.select(planted(rows.doc_id, rows.text)).collect()]
    assert got == ["a  b", None, ""]
