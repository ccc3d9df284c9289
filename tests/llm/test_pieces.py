import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from wordflow.llm.pieces import Encoder, decode, sentencepiece_decode, sentencepiece_encode
from wordflow.llm.sentencepiece_model import Model

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return Encoder(PATH)


def test_ids_spans_and_text(docs, texts, library):
    rows = sentencepiece_decode(sentencepiece_encode(docs, PATH), PATH).collect()
    assert len(rows) == len(texts)
    for r in rows:
        raw = (r.text or "").encode()
        proto = library.encode(r.text or "", return_type="proto")
        assert list(r.pieces.ids) == [p.id for p in proto.pieces]
        assert list(zip(r.pieces.begins, r.pieces.ends, strict=True)) == [(p.begin, p.end) for p in proto.pieces]
        assert r.decoded == library.decode(list(r.pieces.ids))
        assert "".join(raw[a:b].decode() for a, b in zip(r.pieces.begins, r.pieces.ends, strict=True)) == (r.text or "")
        assert r.ids == "own ids"


def test_in_one_pass(docs):
    both = sentencepiece_decode(sentencepiece_encode(docs, PATH, back=True), PATH)
    assert all(r.decoded == r.pieces.decoded for r in both.collect())


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" ▁\n\tabething<>0x́é你😀"), st.characters(exclude_categories=["Cs"]))))
def test_any_text(text):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    own = Encoder(PATH)
    ids = own.encode(text)[0].tolist()
    assert ids == library.encode(text)
    assert decode(own.model, ids) == library.decode(ids)


def test_long_stretch(own, library):
    for text in ("ab" * 4000, " " * 3000, "x" * 20_000, "▁" * 500):
        assert own.encode(text)[0].tolist() == library.encode(text)


def test_any_ids(own, library):
    rng = random.Random(0)
    for _ in range(2000):
        ids = [rng.choice([0, 1, 2, 28705, 35, 200, 230, 231, 290, 1526, rng.randrange(300)]) for _ in range(8)]
        assert decode(own.model, ids) == library.decode(ids)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "nfkc_cf"])
def test_compiled_character_maps(rule):
    """Maps of the library's own rules: the normalised text, and offsets that rise to the end of the text."""
    normaliser = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    model = Model.parse(normaliser.serialized_model_proto())
    model.user_symbols = None
    rng = random.Random(1)
    letters = list("ab ﬁ①Ｈ　㌔ﷺé́\n\t​ß你😀") + ["  ", "é", "\x00"]
    for _ in range(500):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        made, begins = model.normalise(text)
        assert made == normaliser.normalize(text)
        assert len(begins) == len(made) + 1
        assert list(begins) == sorted(begins) and begins[-1] <= len(text.encode())


def test_empty_table(no_docs):
    assert sentencepiece_decode(sentencepiece_encode(no_docs, PATH), PATH).count() == 0


def test_merges_side_by_side_are_those_of_one_stretch_at_a_time(own):
    from wordflow.llm.pieces import LONG, encode_stretch
    from wordflow.llm.piece_merges import Merges

    rng = random.Random(6)
    pieces = [p for p in own.model.pieces if len(p) > 2]
    made = ["".join(rng.choices("abcdeinorst", k=rng.randrange(1, 40))) for _ in range(3000)]
    made += ["▁" + rng.choice(pieces) + rng.choice(pieces)[: rng.randrange(4)] for _ in range(3000)]
    made += ["▁", "a", "x" * LONG, "y" * (LONG + 1), "▁你\x01", "é" * 7, "▁▁▁a"]
    known = 0
    for stretch, found in zip(made, Merges(own.model).encode(made, LONG), strict=True):
        if found is not None:
            ids, sizes = encode_stretch(own.model, stretch)
            assert np.frombuffer(found, np.int32).reshape(-1, 2).T.tolist() == [ids, sizes], stretch
            known += 1
    assert known > 5900 and Merges(own.model).encode([], LONG) == []


def test_a_full_memory_changes_nothing(library, monkeypatch):
    monkeypatch.setattr("wordflow.llm.pieces.CACHE", 50)
    own, rng = Encoder(PATH), random.Random(2)
    for _ in range(60):
        text = " ".join("".join(rng.choices("abcdef", k=rng.randrange(1, 9))) for _ in range(30)) + "z" * rng.randrange(200)
        assert own.encode(text)[0].tolist() == library.encode(text)
    assert len(own.known) < 120 and all(len(s) <= 64 for s in own.known)
