from wordflow.llm.line_dedup import line_dedup

BLANKS = " \t\n\x0b\x0c\r"


def key_of(line):
    return line.strip(BLANKS).encode().lower().decode()


def brute(texts, min_docs=2):
    holders = {}
    for doc, text, *_ in texts:
        for line in (text or "").split("\n"):
            if doc is not None and len(key_of(line)) >= 10:
                holders.setdefault(key_of(line), set()).add(doc)
    for doc, text, *_ in texts:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if doc is None or len(holders.get(key_of(x), ())) < min_docs or min(holders[key_of(x)]) == doc
        ]
        yield doc, "\n".join(kept), len(lines), len(lines) - len(kept)


def test_same_as_brute_force(docs, texts):
    got = line_dedup(docs)
    rows = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()]
    assert sorted(map(str, rows)) == sorted(map(str, brute(texts)))
    assert {r.row for r in got.collect()} == {"own row"}


def test_more_holders_wanted(docs, texts):
    rows = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in line_dedup(docs, min_docs=3).collect()]
    assert sorted(map(str, rows)) == sorted(map(str, brute(texts, 3)))


def test_short_keys_stay_and_non_ascii_case_counts(spark):
    frame = spark.createDataFrame(
        [(1, "short\nÄÖÜ long enough"), (2, "short\näöü long enough"), (3, "ÄÖÜ LONG enough")],
        "doc_id bigint, text string",
    )
    got = {r.doc_id: r.text for r in line_dedup(frame).collect()}
    assert got == {1: "short\nÄÖÜ long enough", 2: "short\näöü long enough", 3: ""}


def test_empty_table(no_docs):
    assert line_dedup(no_docs).count() == 0
