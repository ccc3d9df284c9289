"""WARC archives: written as one gzip stream per file, rewritten as one member per record.

A file that is a single gzip stream cannot be read from the middle. The
normaliser inflates such a stream once, from front to back, gives each record a
gzip member of its own and writes an index of their places beside the archive,
so that readers fetch single records. Each task names its files after its own
attempt and hands on the names; a file of a task that was lost is never read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordflow.llm.common import written
from wordflow.session import shared_folder

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_OK = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

DATE = "1970-01-01T00:00:00Z"
ID_PREFIX = "urn:x-page:"
GZIP = 31
LEVEL = 4
# Bytes before compression after which a task begins another archive.
ARCHIVE_BYTES = 256 << 20
BLOCK = 1 << 20

MANIFEST = "archive string, sidecar string, records bigint"
RECORD = (
    "page_id bigint, uri string, record_type string, payload_digest string, "
    "payload_bytes bigint, refers_to bigint, payload binary"
)


def _open_out(path: str):
    fs, place = pafs.FileSystem.from_uri(path)
    fs.create_dir(place.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(place, compression=None)


def _open_in(path: str):
    fs, place = pafs.FileSystem.from_uri(path)
    return fs.open_input_file(place)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _printable(uri: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", uri)


def record_bytes(page: str | None, uri: str | None, payload: bytes, refers: str | None, spare: str) -> bytes:
    """One record. A revisit keeps the HTTP head, whose length is that of the full payload."""
    name = spare if page is None else page
    head = HTTP_OK.format(len(payload)).encode()
    block = head if refers is not None else head + payload
    fields = {
        "WARC-Type": "response" if refers is None else "revisit",
        "WARC-Record-ID": f"<{ID_PREFIX}{name}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": _printable(uri or f"{ID_PREFIX}{name}"),
        "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if refers is not None:
        fields |= {"WARC-Refers-To": f"<{ID_PREFIX}{refers}>", "WARC-Profile": REVISIT_PROFILE}
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def write_archives(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    min_revisit_bytes: int = 0,
) -> DataFrame:
    """Writes a record per page into archives of one gzip stream; gives their names as a stored table.

    Of pages with equal payloads of at least ``min_revisit_bytes`` the one with the
    largest id is a response and the others are revisits of it. A null page is
    an empty payload. Pages that share that largest id are responses all. A page
    without an id is a revisit if another page with its payload has an id, and a
    response if none has. Other columns are not looked at.
    """
    payload = F.encode(F.coalesce(F.col(f"`{html_column}`"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(f"`{id_column}`").cast("bigint").alias("page_id"),
        F.col(f"`{url_column}`").alias("url"),
        payload.alias("payload"),
    ).select("*", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("size"))
    # Stored, so that Spark can split a payload that very many pages share.
    first = written(
        rows.filter(F.col("size") >= min_revisit_bytes)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", "size", "largest"),
        "payloads",
    )
    own = F.col("page_id").isNotNull() & (F.col("page_id") == F.col("largest"))
    refers = F.when(~own, F.col("largest"))
    # Ids travel as text: pandas would turn whole numbers with nulls into floats.
    records = rows.join(first, ["digest", "size"], "left").select(
        F.col("page_id").cast("string").alias("page_id"), "url", "payload", refers.cast("string").alias("refers_to")
    )

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, path, packer, size, n = None, "", None, 0, 0
        token = uuid.uuid4().hex
        for frame in frames:
            done = []
            columns = (frame[c] for c in ("page_id", "url", "payload", "refers_to"))
            for page, url, body, refer in zip(*columns, strict=True):
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    out, packer, size, n = _open_out(path), zlib.compressobj(LEVEL, wbits=GZIP), 0, 0
                spare = f"none-{token}-{n}"
                record = record_bytes(page, url, bytes(body), refer, spare)
                out.write(packer.compress(record))
                size, n = size + len(record), n + 1
                if size >= ARCHIVE_BYTES:
                    out.write(packer.flush())
                    out.close()
                    done.append((path, None, n))
                    out = None
            if done:
                yield pd.DataFrame(done, columns=["archive", "sidecar", "records"])
        if out is not None:
            out.write(packer.flush())
            out.close()
            yield pd.DataFrame([(path, None, n)], columns=["archive", "sidecar", "records"])

    return written(records.mapInPandas(write, MANIFEST), "archives")


class Inflated:
    """The plain bytes of a gzip file of one or many members, in blocks."""

    def __init__(self, file) -> None:
        self.file, self.left = file, b""
        self.unpacker = zlib.decompressobj(wbits=GZIP)

    def _more(self) -> bool:
        raw = self.unpacker.unconsumed_tail or self.unpacker.unused_data
        if self.unpacker.eof:
            self.unpacker = zlib.decompressobj(wbits=GZIP)
        raw = raw or self.file.read(BLOCK)
        if not raw:
            return False
        self.left += self.unpacker.decompress(raw, BLOCK)
        return True

    def until(self, mark: bytes) -> bytes:
        """Up to and with the mark; empty at the end of the file."""
        begin = 0
        while (at := self.left.find(mark, begin)) < 0:
            begin = max(0, len(self.left) - len(mark))
            if not self._more():
                if self.left.strip():
                    raise ValueError("the archive ends within a record")
                return b""
        found, self.left = self.left[: at + len(mark)], self.left[at + len(mark) :]
        return found

    def take(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes, in parts."""
        while size:
            if not self.left and not self._more():
                raise ValueError("the archive ends within a record")
            part, self.left = self.left[:size], self.left[size:]
            size -= len(part)
            if part:
                yield part


def header_fields(head: bytes) -> dict[str, str]:
    if not head.lstrip().startswith(b"WARC/"):
        raise ValueError("no WARC record where one should begin")
    lines = head.decode().strip().split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines)}


def normalise_stream(source, out) -> Iterator[dict]:
    """Copies each record of ``source`` into a gzip member of ``out``; yields the index entries."""
    plain, offset = Inflated(source), 0
    while head := plain.until(b"\r\n\r\n"):
        fields = header_fields(head)
        packer = zlib.compressobj(LEVEL, wbits=GZIP)
        out.write(packer.compress(head.lstrip()))
        # The two line ends after the block belong to the record.
        for part in plain.take(int(fields["content-length"]) + 4):
            out.write(packer.compress(part))
        out.write(packer.flush())
        end = out.tell()
        yield {
            "offset": offset,
            "length": end - offset,
            "type": fields["warc-type"],
            "id": fields["warc-record-id"],
            "uri": fields.get("warc-target-uri"),
        }
        offset = end


def _one_task_each(manifest: DataFrame) -> DataFrame:
    """The archives dealt out, about one per task."""
    return manifest.repartition(max(1, manifest.count()), "archive")


def normalise_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """Rewrites each archive with a member per record, and an index of JSON lines beside it."""

    def rewrite(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for source in frame["archive"]:
                path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                n = 0
                with _open_in(source) as raw, _open_out(path) as out, _open_out(f"{path}.idx") as index:
                    for entry in normalise_stream(raw, out):
                        index.write(json.dumps(entry).encode() + b"\n")
                        n += 1
                made = (path, f"{path}.idx", n)
                yield pd.DataFrame([made], columns=["archive", "sidecar", "records"])

    return written(_one_task_each(manifest).mapInPandas(rewrite, MANIFEST), "archives")


def _page(name: str | None) -> int | None:
    found = re.fullmatch(rf"<{ID_PREFIX}(-?\d+)>", name or "")
    return int(found[1]) if found else None


def parse_record(member: bytes) -> tuple:
    """The columns of ``RECORD``; the digest of a stored payload is checked."""
    head, _, rest = member.partition(b"\r\n\r\n")
    fields = header_fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    revisit = fields["warc-type"] == "revisit"
    if not revisit and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"damaged record {fields['warc-record-id']}")
    return (
        _page(fields["warc-record-id"]),
        fields.get("warc-target-uri"),
        fields["warc-type"],
        digest,
        size,
        _page(fields.get("warc-refers-to")),
        None if revisit else payload,
    )


def read_archives(manifest: DataFrame, payload: bool = True) -> DataFrame:
    """A row of ``RECORD`` per record, each fetched by its place in the index."""
    columns = [c.split()[0] for c in RECORD.split(", ")]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for archive, sidecar in zip(frame["archive"], frame["sidecar"], strict=True):
                rows, size = [], 0
                with _open_in(archive) as data, _open_in(sidecar) as index:
                    for line in _lines(index):
                        place = json.loads(line)
                        data.seek(place["offset"])
                        member = zlib.decompress(data.read(place["length"]), wbits=GZIP)
                        row = parse_record(member)
                        rows.append(row if payload else (*row[:-1], None))
                        size += len(member) if payload else 200
                        if size >= 8 * BLOCK:
                            yield _records(rows, columns)
                            rows, size = [], 0
                if rows:
                    yield _records(rows, columns)

    return _one_task_each(manifest).mapInPandas(read, RECORD)


def _lines(file) -> Iterator[bytes]:
    left = b""
    while block := file.read(BLOCK):
        *lines, left = (left + block).split(b"\n")
        yield from lines
    if left:
        yield left


def _records(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    # Whole numbers with nulls must not pass through floats.
    found = dict(zip(columns, zip(*rows, strict=True), strict=True))
    return pd.DataFrame(
        {c: pd.array(v, dtype="Int64") if c in ("page_id", "refers_to") else v for c, v in found.items()}
    )


def warc_round_trip(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    min_revisit_bytes: int = 0,
    payload: bool = False,
) -> DataFrame:
    """Writes the pages as archives, normalises them and reads them back: a row of ``RECORD`` per page.

    Null and empty pages are empty payloads; repeated rows are records of their
    own; an empty table writes no archive and gives no rows.
    """
    folder = shared_folder(pages.sparkSession, "warc")
    whole = write_archives(pages, f"{folder}/whole", id_column, url_column, html_column, min_revisit_bytes)
    return read_archives(normalise_archives(whole, f"{folder}/members"), payload)
