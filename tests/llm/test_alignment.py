import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wordflow.llm import alignment
from wordflow.llm.alignment import Alignment, align_tokenizers, byte_letters, gallop, piece_bytes, tokenizers
from wordflow.llm.queries import QUERIES

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF_DIR = "/root/testdata/sf0.001"


def brute(texts):
    """Per text its tokens, groups, overlaps and links, token by token."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    one, two = Tokenizer.from_file(BYTES), SentencePieceProcessor(model_file=PIECES)
    one.encode_special_tokens = True
    letters = byte_letters()
    made = []
    for text in texts:
        a = one.encode(f" {text}", add_special_tokens=False) if text else None
        b = two.encode(text) if text else []
        ids = a.ids if a else []
        spell_a = [bytes(letters[c] for c in t) for t in (a.tokens if a else [])]
        spell_b = [piece_bytes(two.id_to_piece(i)) for i in b]
        whole = f" {text}".encode()
        if not text or b"".join(spell_a) != whole or b"".join(spell_b) != whole:
            made.append(([], [], "", 0, []))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in spell_a]).tolist(), np.cumsum([len(x) for x in spell_b]).tolist()
        groups, links, overlaps, i, j = [], [], 0, 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(",".join(map(str, ids[i:x])) + "|" + ",".join(map(str, b[j:y])))
            links.append((ids[x - 1], b[y - 1]))
            i, j = x, y
        for k, end in enumerate(ends_a):
            begin = ends_a[k - 1] if k else 0
            overlaps += sum(begin < e and (ends_b[m - 1] if m else 0) < end for m, e in enumerate(ends_b))
        made.append((ids, b, ";".join(groups), overlaps, links))
    return made


def figures(texts):
    made = brute(texts)
    counts = Counter(pair for row in made for pair in row[4])
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [
        (len(a), len(b), len(links), overlaps, len(links),
         sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links), groups)
        for a, b, groups, overlaps, links in made
    ]


TEXTS = [
    "", "a", " ", "one two  three", "Größe 你好 😀 é #### $$$", "<|endoftext|> <s> </s> <unk>", "\x00\x01\n\t\r\n  x",
    "unbelievable misunderstandings of tokenization", "1234567 89.01", "▁ under ▁bar", "ﬁn ½ ①", "x" * 90, "<0x41>A",
]


def test_figures_of_awkward_texts(spark):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS + TEXTS[:5])], "doc_id int, text string")
    got = sorted(map(tuple, align_tokenizers(frame.repartition(3), BYTES, PIECES).drop("text").collect()))
    assert [row[1:] for row in got] == figures(TEXTS + TEXTS[:5])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=30), max_size=6))
def test_alignment_of_any_text(texts):
    known = tokenizers(BYTES, PIECES)
    found = Alignment(known, known.encode(texts))
    wanted = brute(texts)
    assert found.shown() == [w[2] for w in wanted]
    assert found.overlaps.tolist() == [w[3] for w in wanted]
    assert found.groups.tolist() == [len(w[4]) for w in wanted]
    assert [(p >> 32, p & 0xFFFFFFFF) for p in found.pairs().tolist()] == [p for w in wanted for p in w[4]]


@given(st.lists(st.integers(1, 9), min_size=1, max_size=300), st.data())
def test_galloping_finds_the_lower_bound(gaps, data):
    ends = np.cumsum(gaps)
    wanted = np.array(data.draw(st.lists(st.integers(0, int(ends[-1])), max_size=40)), np.int64)
    places = [bisect_left(ends.tolist(), w) for w in wanted]
    begin = np.array([data.draw(st.integers(0, p)) for p in places], np.int64)
    assert gallop(ends, wanted, begin).tolist() == places


def test_rows(spark, docs, texts, no_docs, monkeypatch):
    rows = align_tokenizers(docs.withColumnRenamed("lang", "groups"), BYTES, PIECES, digest=True).collect()
    wanted = Counter(
        (row[0], *f[:-1], hashlib.sha256(f[-1].encode()).hexdigest() if f[-1] else "")
        for row, f in zip(texts, figures_fast([t or "" for _, t, *_ in texts]), strict=True)
    )
    names = alignment.RESULTS
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in rows) == wanted
    assert {r.fp for r in rows} == {"own fp"}
    assert align_tokenizers(no_docs, BYTES, PIECES).count() == 0


def figures_fast(texts):
    """``figures``, with the tokens of long texts aligned by a merge instead."""
    known = tokenizers(BYTES, PIECES)
    made = []
    for a, b in known.encode(texts):
        ends_a, ends_b = (np.cumsum(s[np.array(x, int)]).tolist() if x else [] for s, x in ((known.sizes_a, a), (known.sizes_b, b)))
        groups, links, overlaps, i, j, x, y = [], [], 0, 0, 0, 0, 0
        while x < len(a) and y < len(b):
            overlaps += 1
            if ends_a[x] == ends_b[y]:
                groups.append(",".join(map(str, a[i : x + 1])) + "|" + ",".join(map(str, b[j : y + 1])))
                links.append((a[x], b[y]))
                x, y = x + 1, y + 1
                i, j = x, y
            elif ends_a[x] < ends_b[y]:
                x += 1
            else:
                y += 1
        made.append((a, b, ";".join(groups), overlaps, links))
    counts = Counter(pair for row in made for pair in row[4])
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [
        (len(a), len(b), len(links), o, len(links), sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links), g)
        for a, b, g, o, links in made
    ]


def test_both_brute_forms_agree():
    assert figures_fast(TEXTS) == figures(TEXTS)


@pytest.mark.parametrize("links", [1 << 20, 500])
def test_query(spark, monkeypatch, links):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    if links < 1 << 20:
        rows = align_tokenizers(
            spark.createDataFrame(documents, "doc_id bigint, text string").repartition(40), BYTES, PIECES, digest=True
        ).collect()
        got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in rows}
    else:
        rows = QUERIES["op13_tokenizer_alignment"](spark, SF_DIR).collect()
        got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows}
    wanted = {
        d: (a, b, n, m, best, total, hashlib.sha256(g.encode()).hexdigest() if g else "")
        for (d, _), (a, b, n, _, m, best, total, g) in zip(documents, figures_fast([t or "" for _, t in documents]), strict=True)
    }
    assert got == wanted
