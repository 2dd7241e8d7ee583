"""WARC derivatives: metadata and plain-text conversion records of web pages' response records.

A record is its header fields in order and a block of bytes; ``serialized`` and ``parse`` are inverse. For
each response a metadata record (title, language, links) and a conversion record (plain text) are made; both name the
response in WARC-Refers-To, and its target, date and digests, and carry digests of their own. Ids are made of
what a record says, so a task that runs again makes the same records.

Files hold one gzip member for each record. Each attempt of a task writes under a new name, and the manifest, which Spark
commits, names those that count.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote, urljoin

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postweave.llm.batches import file_uri, slabs
from postweave.plans.storage import new_path, stored

VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("9f2c1f6e-6a53-4f0c-8a53-6d1f3f0f7a11")
READ_BYTES = 4 << 20
# Bytes given to a decompressor at once; what lies behind a record's end is copied, so these are few.
UNZIP_BYTES = 16 << 10
# The field that carries the id of a page from its row to its records.
PAGE_ID = "X-Page-ID"

Fields = list[tuple[str, str]]

# A tag ends before the next one begins, so that a page is scanned once even if its tags never end.
OPENING = re.compile(r"<!--|<(script|style|noscript|template|svg|iframe)\b[^<>]*>|<!doctype[^<>]*>", re.I)
CLOSING = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "noscript", "template", "svg", "iframe")}
TITLE, TITLE_END = re.compile(r"<title[^<>]*>", re.I), re.compile(r"</title\s*>", re.I)
LANGUAGE = re.compile(r"<html[^<>]*?\blang\s*=\s*[\"']?([\w-]+)", re.I)
LINK = re.compile(r"<a\b[^<>]*?\bhref\s*=\s*(?:\"([^\"<]*)\"|'([^'<]*)'|([^\s<>]+))", re.I)
BREAK = re.compile(r"</?(?:p|div|br|li|ul|ol|tr|table|h[1-6]|article|section|header|footer|nav|main|aside|blockquote|pre|head|body|title)\b[^<>]*>", re.I)
TAG = re.compile(r"<[^<>]*>")
# A path from the root, without dot segments, empty ones or further parts, stays as it is when it is joined to a URL.
PLAIN_PATH = re.compile(r"(?:/[\w-][\w.-]*)+")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str | None) -> str:
    """An id that depends on the parts only; null is told apart from an empty one."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, repr(parts))}>"


def response(page_id, url: str | None, page: str | None) -> tuple[Fields, bytes]:
    """The response record of a page; a null page is an empty one, a null url leaves the target out."""
    payload = (page or "").encode()
    payload_digest = digest(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + payload
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", str(page_id), url, payload_digest)), ("WARC-Date", DATE)]
    fields += [("WARC-Target-URI", _one_line(url))] if url is not None else []
    fields += [(PAGE_ID, quote(str(page_id), safe=""))] if page_id is not None else []
    fields += [("Content-Type", "application/http; msgtype=response"), ("WARC-Identified-Payload-Type", "text/html")]
    fields += [("WARC-Payload-Digest", payload_digest), ("WARC-Block-Digest", digest(block)), ("Content-Length", str(len(block)))]
    return fields, block


def _one_line(text: str) -> str:
    return " ".join(text.split())


def payload_of(block: bytes) -> tuple[bytes, bytes]:
    """HTTP head and body of a response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    return head, body


def without_hidden(page: str) -> str:
    """The page with a blank for each comment, script, style and the like; one that never ends stays as it is."""
    parts, at, endless = [], 0, set()
    place = 0
    while found := OPENING.search(page, place):
        place = found.end()
        name = (found[1] or "").lower()
        stop = None
        if found[0] == "<!--":
            stop = page.find("-->", place) + 3 if "-->" not in endless else 2
            if stop == 2:
                endless.add("-->")
                continue
        elif name:
            end = CLOSING[name].search(page, place) if name not in endless else None
            if end is None:
                endless.add(name)
                continue
            stop = end.end()
        parts += [page[at : found.start()], " "]
        at = place = stop or place
    return "".join([*parts, page[at:]])


def title_of(page: str) -> str | None:
    first = TITLE.search(page)
    last = first and TITLE_END.search(page, first.end())
    return page[first.end() : last.start()] if last else None


def plain_text(page: str, shown: str | None = None) -> str:
    """Text of a page: no scripts, styles or comments; block elements begin lines; entities resolved.

    ``shown`` is the page without hidden parts, where it is known.
    """
    text = TAG.sub("", BREAK.sub("\n", without_hidden(page) if shown is None else shown))
    lines = (_one_line(line) for line in html.unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def page_metadata(page: str, url: str | None, shown: str | None = None) -> Fields:
    """Title, language and links in the order of the page; ``shown`` as in ``plain_text``."""
    title, language = title_of(page), LANGUAGE.search(page)
    out = [("title", _one_line(html.unescape(TAG.sub("", title))))] if title is not None else []
    out += [("language", language[1].lower())] if language else []
    root = _joined(url, "/")
    for found in LINK.finditer(without_hidden(page) if shown is None else shown):
        target = html.unescape(found[found.lastindex]).strip()
        target = root + target[1:] if PLAIN_PATH.fullmatch(target) else _joined(url, target)
        out.append(("outlink", _one_line(target)))
    return out


def _joined(url: str | None, target: str) -> str:
    """The target as seen from the URL; as it is, if one of them is no URL."""
    try:
        return urljoin(url or "", target)
    except ValueError:
        return target


def http_fields(head: bytes) -> Fields:
    """The fields of an HTTP head, each in one line, under names that tell them from those of the record."""
    lines = head.decode("latin-1").split("\r\n")[1:]
    return [(f"X-HTTP-{name.strip()}", _one_line(value)) for name, mark, value in (line.partition(":") for line in lines) if mark and name.strip()]


def derivatives(fields: Fields, block: bytes) -> list[tuple[Fields, bytes]]:
    """The metadata and the conversion record of a response record, both with the fields of its HTTP head."""
    source = dict(fields)
    head, body = payload_of(block)
    page, url = body.decode("utf-8", "replace"), source.get("WARC-Target-URI")
    shown, of_http = without_hidden(page), http_fields(head)
    about = [("http-status", head.split(b"\r\n")[0].decode("latin-1"))] + page_metadata(page, url, shown)
    blocks = {
        "metadata": ("application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in about).encode()),
        "conversion": ("text/plain; charset=utf-8", plain_text(page, shown).encode()),
    }
    out = []
    for kind, (content_type, data) in blocks.items():
        own = [("WARC-Type", kind), ("WARC-Record-ID", record_id(kind, source["WARC-Record-ID"])), ("WARC-Date", source["WARC-Date"])]
        own += [(k, source[k]) for k in ("WARC-Target-URI", PAGE_ID) if k in source]
        own += [
            ("WARC-Refers-To", source["WARC-Record-ID"]),
            ("WARC-Refers-To-Date", source["WARC-Date"]),
            ("WARC-Source-Payload-Digest", source["WARC-Payload-Digest"]),
            ("WARC-Source-Content-Type", source["WARC-Identified-Payload-Type"]),
            *of_http,
            ("Content-Type", content_type),
            ("WARC-Block-Digest", digest(data)),
            ("Content-Length", str(len(data))),
        ]
        out.append((own, data))
    return out


def serialized(fields: Fields, block: bytes) -> bytes:
    head = "".join([f"{VERSION}\r\n", *(f"{k}: {v}\r\n" for k, v in fields), "\r\n"])
    return head.encode() + block + b"\r\n\r\n"


def parse(record: bytes) -> tuple[Fields, bytes]:
    """Fields and block of one whole record; its length and digest must hold."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = [tuple(line.split(": ", 1)) for line in lines]
    named = dict(fields)
    block = rest[: int(named["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n" or named.get("WARC-Block-Digest", digest(block)) != digest(block):
        raise ValueError(f"damaged record {named.get('WARC-Record-ID')}")
    return fields, block


def read_records(path: str) -> Iterator[bytes]:
    """The records of a file, one gzip member at a time."""
    filesystem, inner = fs.FileSystem.from_uri(path)
    with filesystem.open_input_stream(inner, compression=None) as file:
        unzip = zlib.decompressobj(31)
        parts: list[bytes] = []
        while data := file.read(READ_BYTES):
            at = 0
            while at < len(data):
                some = data[at : at + UNZIP_BYTES]
                parts.append(unzip.decompress(some))
                at += len(some) - len(unzip.unused_data)
                if unzip.eof:
                    yield b"".join(parts)
                    parts, unzip = [], zlib.decompressobj(31)
        if any(parts):
            raise ValueError(f"{path} ends within a record")


def write_derivatives(pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Write both records of every page; the manifest (file, records). Pages stay with their input splits."""
    folder = file_uri(pages.sparkSession, folder or new_path(pages.sparkSession, "derivatives"))
    plain = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, count = None, None, 0
        for batch in slabs(batches):
            if out is None:
                parent, inner = fs.FileSystem.from_uri(folder)
                parent.create_dir(inner, recursive=True)
                path = f"{folder}/part-{uuid.uuid4().hex}.warc.gz"
                # Members are compressed here, not the stream as a whole.
                out = parent.open_output_stream(f"{inner}/{path.rsplit('/', 1)[1]}", compression=None)
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "text"))):
                for record in derivatives(*response(*row)):
                    zipper = zlib.compressobj(3, zlib.DEFLATED, 31)
                    out.write(zipper.compress(serialized(*record)) + zipper.flush())
                    count += 1
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [path], "records": [count]})

    return stored(plain.mapInArrow(write, "file string, records long"), "warc-manifest")


RECORD = (
    "page_id string, record_id string, record_type string, refers_to string, target_uri string, date string, content_type string,"
    " source_payload_digest string, block_digest string, content_length long, block binary"
)


def read_warc(manifest: DataFrame) -> DataFrame:
    """The records of the files of a manifest, one file for each task."""
    files = manifest.select("file")
    listed = files.repartitionByRange(max(1, files.count()), "file")
    names = (PAGE_ID, "WARC-Record-ID", "WARC-Type", "WARC-Refers-To", "WARC-Target-URI", "WARC-Date", "Content-Type", "WARC-Source-Payload-Digest")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(f.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]]) for f in RECORD.split(",")]
        )
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                for record in read_records(path):
                    fields, block = parse(record)
                    named = dict(fields)
                    if PAGE_ID in named:
                        named[PAGE_ID] = unquote(named[PAGE_ID])
                    rows.append((*map(named.get, names), named["WARC-Block-Digest"], len(block), block))
                    size += len(block)
                    if size >= READ_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return listed.mapInArrow(read, RECORD)


def derivative_report(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row for each derivative record, read back from the files, with the page_id of its response.

    Null pages give empty texts, null urls records without target. Rows with equal id, url and page have equal records, one
    for each row. No rows: no files and no rows.
    """
    records = read_warc(write_derivatives(pages, page_id=page_id, url=url, page=page))
    return records.select(
        F.col("page_id").cast(pages.schema[page_id].dataType).alias("page_id"),
        "record_id",
        "record_type",
        "refers_to",
        "target_uri",
        "source_payload_digest",
        "block_digest",
        "content_length",
        F.crc32("block").alias("block_crc32"),
    )
