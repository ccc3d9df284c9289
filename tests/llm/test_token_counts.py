from collections import Counter

import public_tokenizers
import pytest
import tiktoken

from wordflow.llm.queries import QUERIES
from wordflow.llm.token_counts import (
    Rollup,
    count_documents,
    deletes,
    deltas,
    encoding,
    inserts,
    later_copies,
    revisions,
)
from wordflow.session import shared_folder

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
KEYS = "source string, lang string, tokenizer string"


@pytest.fixture
def rollup(spark):
    return Rollup(spark, shared_folder(spark, "rollup-test"))


@pytest.fixture(scope="module")
def counted(docs):
    return count_documents(docs, "v1", PATH, PATTERN)


def totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens, r.changes) for r in rollup.totals().collect()}


def test_counts_are_the_library_s(counted, texts):
    own = encoding(PATH, PATTERN)
    assert isinstance(own, tiktoken.Encoding)
    wanted = Counter((doc, source, lang, len(own.encode_ordinary(t or ""))) for doc, t, lang, source in texts)
    assert Counter((r.doc_id, r.source, r.lang, r.tokens) for r in counted.collect()) == wanted


def test_inserts_revisions_and_deletes(rollup, counted, texts):
    own = encoding(PATH, PATTERN)
    assert rollup.commit("1", inserts(counted, "guess"))
    assert rollup.commit("2", revisions(counted, "guess", "tokens"))
    assert rollup.commit("3", deletes(later_copies(counted)))
    first = {}
    for doc, text, *_ in texts:
        if doc is not None:
            first[text or ""] = min(doc, first.get(text or "", doc))
    wanted = {}
    for doc, text, lang, source in texts:
        n, tokens, changes = wanted.get((source, lang, "v1"), (0, 0, 0))
        copy = doc is not None and doc > first[text or ""]
        size = 0 if copy else len(own.encode_ordinary(text or ""))
        wanted[source, lang, "v1"] = (n + (not copy), tokens + size, changes + 2 + copy)
    assert totals(rollup) == wanted


def test_a_batch_counts_once(spark, rollup):
    change = spark.createDataFrame([("s", "en", "v1", None, 5)], f"{KEYS}, before bigint, after bigint")
    assert rollup.commit("a", change)
    assert not rollup.commit("a", change)
    assert totals(rollup) == {("s", "en", "v1"): (1, 5, 1)}
    assert rollup.commit("b", change)
    assert totals(rollup) == {("s", "en", "v1"): (2, 10, 2)}
    assert rollup.committed() == ["a", "b"]


def test_a_batch_cut_short_is_written_anew(spark, rollup):
    change = spark.createDataFrame([("s", "en", "v1", None, 5)], f"{KEYS}, before bigint, after bigint")
    rollup.commit("a", change)
    fs, mark = rollup._place("batch=a", "_SUCCESS")
    fs.delete(mark, False)
    assert rollup.committed() == [] and totals(rollup) == {}
    assert rollup.commit("a", change)
    assert totals(rollup) == {("s", "en", "v1"): (1, 5, 1)}


def test_nulls_and_versions(spark, rollup):
    rows = [(None, None, "v1", None, 3), (None, None, "v2", None, 4), ("s", None, "v1", 7, None), ("s", None, "v1", None, None)]
    rollup.commit("x", spark.createDataFrame(rows, f"{KEYS}, before bigint, after bigint"))
    assert totals(rollup) == {
        (None, None, "v1"): (1, 3, 1), (None, None, "v2"): (1, 4, 1), ("s", None, "v1"): (-1, -7, 2),
    }


def test_empty(spark, rollup, no_docs):
    assert rollup.totals().count() == 0
    none = count_documents(no_docs, "v1", PATH, PATTERN)
    assert rollup.commit("none", inserts(none)) and rollup.totals().count() == 0
    with pytest.raises(ValueError, match="batch id"):
        rollup.commit("../x", inserts(none))


def test_folded_batches_count_once(spark, rollup):
    change = spark.createDataFrame([("s", "en", "v1", None, 5)], f"{KEYS}, before bigint, after bigint")
    assert not rollup.compact()
    for batch in "abc":
        assert rollup.commit(batch, change)
    assert rollup.compact() and not rollup.compact()
    assert totals(rollup) == {("s", "en", "v1"): (3, 15, 3)}
    assert not rollup.commit("b", change) and rollup.committed() == ["a", "b", "c"]
    assert rollup.commit("d", change) and totals(rollup) == {("s", "en", "v1"): (4, 20, 4)}
    assert rollup.compact() and totals(rollup) == {("s", "en", "v1"): (4, 20, 4)}
    assert rollup.committed() == ["a", "b", "c", "d"]
    fs, path = rollup._place()
    assert [s.getPath().getName() for s in fs.listStatus(path)] == ["base=2"]


def test_a_folding_cut_short_loses_nothing(spark, rollup):
    change = spark.createDataFrame([("s", "en", "v1", None, 5)], f"{KEYS}, before bigint, after bigint")
    for batch in "ab":
        rollup.commit(batch, change)
    # Cut before its mark: the batches count, not the table.
    rollup.totals().write.parquet(f"{rollup.folder}/base=1/totals")
    assert totals(rollup) == {("s", "en", "v1"): (2, 10, 2)}
    assert rollup.compact()
    # Cut before the removal: the table counts, not the batch that is still there.
    deltas(change).write.parquet(f"{rollup.folder}/batch=a")
    assert totals(rollup) == {("s", "en", "v1"): (2, 10, 2)} and not rollup.compact()


def test_query_recounted(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    old = encoding(PATH, PATTERN)
    new = encoding(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), PATTERN)
    first = {}
    for doc, text, *_ in rows:
        first[text] = min(doc, first.get(text, doc))
    wanted = Counter()
    for doc, text, lang, source in rows:
        later = doc > first[text]
        if not later:
            wanted[source, lang, "byte_bpe_multi_50k", "documents"] += 1
            wanted[source, lang, "byte_bpe_multi_50k", "tokens"] += len(new.encode_ordinary(text))
        stays = not later and lang == "en"
        wanted[source, lang, "byte_bpe_50k", "documents"] += stays
        wanted[source, lang, "byte_bpe_50k", "tokens"] += len(old.encode_ordinary(text)) if stays else 0
    got = {}
    for r in QUERIES["op8_token_counts"](spark, sf_dir).collect():
        got[r.source, r.lang, r.tokenizer, "documents"] = r.documents
        got[r.source, r.lang, r.tokenizer, "tokens"] = r.tokens
    assert got == dict(wanted)
