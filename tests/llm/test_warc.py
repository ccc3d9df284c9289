import gzip
import io
import zlib

import pytest

from wordflow.llm.warc import (
    Inflated,
    base32_sha1,
    normalise_archives,
    normalise_stream,
    parse_record,
    read_archives,
    record_bytes,
    warc_round_trip,
    write_archives,
)
from wordflow.session import shared_folder

PAGES = [
    (1, "http://a/", "<p>one</p>"),
    (2, "http://a/2", "<p>one</p>"),
    (3, "http://b/ x\r\n", "<p>Größe 你好</p>\r\n\r\nWARC/1.1\r\n"),
    (4, None, None),
    (5, "http://c/", ""),
    (5, "http://c/", ""),
    (6, "http://d/", "z" * 3_000_000),
    (None, "http://e/", "<p>one</p>"),
    (None, "http://f/", "nobody else has this"),
    (2**53 + 1, "http://g/", "big id"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(
        [(*p, "own") for p in PAGES], "page_id bigint, url string, html string, payload string"
    )


def brute(pages, least=0):
    largest = {}
    for page, _, html in pages:
        if page is not None:
            largest[html or ""] = max(page, largest.get(html or "", page))
    for page, _, html in pages:
        body = (html or "").encode()
        first = largest.get(html or "")
        revisit = len(body) >= least and first is not None and page != first
        yield page, len(body), base32_sha1(body), "revisit" if revisit else "response", first if revisit else None


@pytest.mark.parametrize("least", [0, 11])
def test_round_trip(pages, least):
    got = warc_round_trip(pages, min_revisit_bytes=least, payload=True).collect()
    rows = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(map(str, rows)) == sorted(map(str, brute(PAGES, least)))
    for r in got:
        assert (r.payload is None) == (r.record_type == "revisit")
        assert r.payload is None or base32_sha1(bytes(r.payload)) == r.payload_digest


def test_members_stand_alone(spark, pages):
    folder = shared_folder(spark, "warc-test")
    whole = write_archives(pages, f"{folder}/whole")
    made = normalise_archives(whole, f"{folder}/members")
    assert sum(r.records for r in whole.collect()) == sum(r.records for r in made.collect()) == len(PAGES)
    for r in whole.collect():
        with open(r.archive, "rb") as file:
            one = zlib.decompressobj(wbits=31)
            one.decompress(file.read())
            assert one.eof and not one.unused_data
    assert read_archives(made).count() == len(PAGES)


def test_normaliser_copies_bytes():
    records = [record_bytes(str(i), "http://x/", b"body" * i, None, "") for i in range(40)]
    source = gzip.compress(b"".join(records[:25])) + gzip.compress(b"".join(records[25:]))
    out = io.BytesIO()
    entries = list(normalise_stream(io.BytesIO(source), out))
    data = out.getvalue()
    for record, e in zip(records, entries, strict=True):
        assert gzip.decompress(data[e["offset"] : e["offset"] + e["length"]]) == record
    assert entries[-1]["offset"] + entries[-1]["length"] == len(data)


def test_damage_is_noticed():
    record = record_bytes("1", "http://x/", b"hello", None, "")
    with pytest.raises(ValueError, match="damaged"):
        parse_record(record.replace(b"hello", b"jello"))
    with pytest.raises(ValueError, match="within a record"):
        list(normalise_stream(io.BytesIO(gzip.compress(record[:-9])), io.BytesIO()))
    assert Inflated(io.BytesIO(b"")).until(b"\r\n") == b""


def test_empty_table(pages):
    assert warc_round_trip(pages.limit(0)).count() == 0
