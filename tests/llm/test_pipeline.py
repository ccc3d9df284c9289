import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from tests.llm import test_decontamination as leaks
from tests.llm import test_line_dedup as lines
from tests.llm import test_simhash as near
from tests.llm.conftest import SCHEMA, prose
from wordflow.llm.quality import quality_rules
from wordflow.session import shared_folder


def corpus():
    rng = random.Random(2)
    items = [(i, prose(900 + i, 20).replace("\n", " ")) for i in range(5)]
    rows = []
    for i in range(40):
        text = prose(i // 2 if i % 4 < 2 else i, 60)
        if i % 7 == 0:
            text += "\nA line that many documents share.\n" + prose(1000 + i, 10)
        if i % 9 == 0:
            text += "\n" + rng.choice(items)[1]
        if i % 11 == 0:
            text = " ".join(f"{w}###" for w in text.split())
        rows.append((i, text, rng.choice(["en", None]), rng.choice(["a", "b"])))
    rows += [rows[5], (None, prose(77, 50), "en", "a"), (None, None, None, None), (99, "", "en", "a")]
    return rows, items


@pytest.fixture(scope="module")
def tables(spark):
    rows, items = corpus()
    folder = shared_folder(spark, "pipeline-test")
    frame = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA)
    frame.withColumn("kept", F.lit("own kept")).withColumn("row", F.lit("own row")).write.parquet(
        f"{folder}/documents.parquet"
    )
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def bag(rows):
    return Counter((r[0], r[1]) for r in rows)


def test_stages_do_what_they_say(spark, tables):
    folder, rows, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        path = shared_folder(spark, f"pipeline-test-{name}")
        stage(spark, before, folder).write.parquet(path)
        after = spark.read.parquet(path)
        old = [(r.doc_id, r.text, r.lang, r.source) for r in before.collect()]
        if name == "quality_rules":
            judged = quality_rules(before.drop("kept")).filter("kept").collect()
            wanted = bag((r.doc_id, r.text) for r in judged)
        elif name == "line_dedup":
            wanted = bag((doc, text) for doc, text, *_ in lines.brute(old))
        elif name == "simhash":
            groups = near.brute_groups([(doc, near.brute_print(text)) for doc, text, *_ in old])
            wanted = bag({(d, t) for (d, t, *_), g in zip(old, groups, strict=True) if d is not None and d == g})
            wanted += bag((d, t) for d, t, *_ in old if d is None)
        elif name == "decontamination":
            found = leaks.brute([(t, t) for _, t, *_ in old], items, 2)
            bad = {t for (t, item), n in found.items() if 5 * n >= len(leaks.normal_words(dict(items)[item]))}
            wanted = bag((d, t) for d, t, *_ in old if t not in bad)
        else:
            got = Counter((r.doc_id, tuple(r.ids), r.n_tokens) for r in after.collect())
            ids = [(doc, tuple(library.encode(text or ""))) for doc, text, *_ in old]
            assert got == Counter((doc, i, len(i)) for doc, i in ids)
            continue
        assert bag((r.doc_id, r.text) for r in after.collect()) == wanted, name
        assert sum(wanted.values()) < len(old) or name == "line_dedup"
        assert after.columns == docs.columns
        assert {(r.kept, r.row) for r in after.collect()} == {("own kept", "own row")}
        before = after


def test_run_is_the_stages_in_order(spark, tables):
    folder, *_ = tables
    got = corpus_pipeline.run(spark, folder)
    assert got.count() > 10
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "simhash", "decontamination", "sentencepiece",
    ]


def test_no_documents(spark, tables):
    folder, *_ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


def test_all_are_registered():
    names = list(driver.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
