"""WARC derivatives: metadata and plain-text conversion records linked to their responses.

A response is an HTTP message with the URI it came from. From each one two records are
derived. Both name the response in ``WARC-Refers-To`` and carry its URI and date; the
metadata record holds the response's status, headers and digests and what the page says
about itself, the conversion record its text. Ids are name-based UUIDs of the response and
the kind of record, so a run that is repeated after a lost executor writes the same bytes.

Records are made row by row, without a shuffle, and are bytes that can be written one after
the other to make a file; ``parse`` reads them back.

A message's body is decoded as its headers say: chunks are joined, gzip and deflate undone, and
text read in the charset of the header, of the page, or as UTF-8. HTML gives the text of its blocks,
any other text itself, everything else an empty conversion.

Defined results: a NULL page is an empty payload, a NULL URI an empty one; header names and
values lose line breaks, which would forge headers; optional headers may be missing, and a
payload digest that is missing is computed; a body that does not follow its headers is taken as it
is; what is no response record gives one row of type ``error`` that says why; a NULL response gives
none; a row whose id is NULL gets the ids of
an unnamed page; repeated rows give repeated records with the same ids; other columns are
ignored.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from salestide.llm.dom import read_page
from salestide.llm.rows import named

#: The day that stands in records of pages without one, so that reruns agree.
DATE = "2024-01-01T00:00:00Z"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
BREAKS = re.compile(r"[\r\n\x00]+")
VERSION = "WARC/1.1"


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, chr(31).join(parts))}>"


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def with_block(headers: list[tuple[str, str]], block: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and bytes of one record; its length and digest are added to the headers."""
    more = [("WARC-Block-Digest", digest(block)), ("Content-Length", str(len(block)))]
    whole = {BREAKS.sub(" ", n): BREAKS.sub(" ", v) for n, v in [*headers, *more]}
    lines = [f"{name}: {value}" for name, value in whole.items()]
    return whole, "\r\n".join([VERSION, *lines, "", ""]).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> list[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a file."""
    found, at = [], 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if version != VERSION:
            raise ValueError(f"not a record at byte {at}")
        parts = (line.partition(":") for line in lines)
        headers = {name.strip(): value.strip() for name, _, value in parts}
        if not headers.get("Content-Length", "").isdigit():
            raise ValueError(f"the record at byte {at} has no length")
        start = end + 4
        at = start + int(headers["Content-Length"])
        found.append((headers, data[start:at]))
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"the record that ends at byte {at} is not closed")
        at += 4
    return found


def response(key: str, uri: str, html: str, date: str = DATE) -> bytes:
    """A response record of a page that was fetched without trouble."""
    payload = html.encode()
    head = [
        "HTTP/1.1 200 OK",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(payload)}",
    ]
    block = "\r\n".join([*head, "", ""]).encode() + payload
    headers = [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", record_id("response", key, uri)),
        ("WARC-Target-URI", uri),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", digest(payload)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return with_block(headers, block)[1]


def read_response(source: bytes) -> tuple[dict[str, str], bytes]:
    found = parse(source)
    if len(found) != 1 or found[0][0].get("WARC-Type") != "response":
        raise ValueError("a single response record is expected")
    return found[0]


def joined_chunks(body: bytes) -> bytes:
    """The data of a chunked body; a body that is none as it is."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size):
            return body
        start, size = end + 2, int(size, 16)
        if size == 0:
            return b"".join(out)
        if body[start + size : start + size + 2] != b"\r\n":
            return body
        out.append(body[start : start + size])
        at = start + size + 2


def inflated(body: bytes, coding: str) -> bytes:
    """A compressed body's data; a broken or unknown one as it is."""
    for bits in {"gzip": [47], "x-gzip": [47], "deflate": [47, -15]}.get(coding, []):
        try:
            return zlib.decompressobj(bits).decompress(body)
        except zlib.error:
            continue
    return body


def decoded(http: dict[str, str], body: bytes) -> tuple[str, str]:
    """The media type and the text of a message's body; no text for what is not text."""
    if "chunked" in http.get("transfer-encoding", "").lower():
        body = joined_chunks(body)
    for coding in reversed(http.get("content-encoding", "").lower().split(",")):
        body = inflated(body, coding.strip())
    kind, _, rest = http.get("content-type", "text/html").partition(";")
    kind = kind.strip().lower()
    if not kind.startswith("text/") and kind != "application/xhtml+xml":
        return kind, ""
    named_by = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", rest, re.I)
    within = None if named_by else re.search(rb"<meta[^>]{0,200}charset\s*=\s*[\"']?([\w.:-]+)", body[:2048], re.I)
    charset = named_by[1] if named_by else within[1].decode() if within else "utf-8"
    try:
        codecs.lookup(charset)
        return kind, body.decode(charset, "replace")
    except (LookupError, UnicodeError):
        return kind, body.decode("utf-8", "replace")


def derive(headers: dict[str, str], block: bytes) -> list[tuple[dict[str, str], bytes, bytes]]:
    """Headers, block and bytes of the metadata and the conversion record of a response."""
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *http = head.decode("latin-1").split("\r\n")
    pairs = [(name.strip(), value.strip()) for name, _, value in (line.partition(":") for line in http)]
    kind, text = decoded({name.lower(): value for name, value in pairs}, payload)
    page = read_page(text if "html" in kind else None)
    own = headers.get("WARC-Record-ID", "")
    uri, date = headers.get("WARC-Target-URI", ""), headers.get("WARC-Date", DATE)
    kept = [
        ("WARC-Refers-To", own),
        ("WARC-Refers-To-Target-URI", uri),
        ("WARC-Refers-To-Date", date),
        ("WARC-Target-URI", uri),
        ("WARC-Date", date),
    ]
    fields = [
        ("http-status", status),
        *[("http-header", line) for line in http],
        ("source-block-digest", headers.get("WARC-Block-Digest") or digest(block)),
        ("source-payload-digest", payload_digest(headers, block)),
        ("source-length", headers.get("Content-Length", str(len(block)))),
        ("title", page.title),
        *[("outlink", link) for link in page.links],
    ]
    meta = "".join(f"{name}: {BREAKS.sub(' ', value)}\r\n" for name, value in fields).encode()
    text = "\n".join(b.text for b in page.blocks) if "html" in kind else text
    text = text.encode("utf-8", "replace")
    made = []
    for kind, mime, data in (
        ("metadata", "application/warc-fields", meta),
        ("conversion", "text/plain; charset=utf-8", text),
    ):
        first = [("WARC-Type", kind), ("WARC-Record-ID", record_id(kind, own))]
        extra = [("WARC-Source-Content-Type", value) for name, value in pairs if name.lower() == "content-type"]
        own_headers, whole = with_block([*first, *kept, *extra, ("Content-Type", mime)], data)
        made.append((own_headers, data, whole))
    return made


def payload_digest(headers: dict[str, str], block: bytes) -> str:
    """As the record says, or of the body as it was sent."""
    return headers.get("WARC-Payload-Digest") or digest(block.partition(b"\r\n\r\n")[2])


COLUMNS = [
    ("record_type", "WARC-Type"),
    ("record_id", "WARC-Record-ID"),
    ("refers_to", "WARC-Refers-To"),
    ("target_uri", "WARC-Target-URI"),
    ("block_digest", "WARC-Block-Digest"),
    ("content_type", "Content-Type"),
]


def responses(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """``page_id, response``: each page as a response record."""
    rows = named(pages, page_id=page_id, url=url, html=html)
    kind = rows.schema["page_id"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                response("" if key is None else str(key), uri or "", text.as_py() or "")
                for key, uri, text in zip(
                    batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), batch.column("html")
                )
            ]
            columns = [batch.column("page_id"), pa.array(made, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "response"])

    return rows.mapInArrow(make, f"page_id {kind}, response binary")


def derivatives(rows: DataFrame, page_id: str = "page_id", source: str = "response") -> DataFrame:
    """Two rows for each response: ``page_id``, the columns of ``COLUMNS``, the response's
    ``source_digest``, ``content_length``, the ``record`` itself and an ``error``, if any."""
    rows = named(rows, page_id=page_id, source=source)
    kind = rows.schema["page_id"].dataType.simpleString()
    names = [name for name, _ in COLUMNS]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(name, pa.string()) for name in names]
            + [("source_digest", pa.string()), ("content_length", pa.int64()), ("record", pa.binary())]
            + [("error", pa.string())]
        )
        for batch in batches:
            keys, made = [], []
            for at, data in enumerate(batch.column("source")):
                source = data.as_py()
                if source is None:
                    continue
                try:
                    response_headers, message = read_response(source)
                except ValueError as broken:
                    keys.append(at)
                    made.append({"record_type": "error", "error": str(broken)})
                    continue
                payload = payload_digest(response_headers, message)
                for headers, block, whole in derive(response_headers, message):
                    keys.append(at)
                    row = {name: headers.get(header) for name, header in COLUMNS}
                    row |= {"source_digest": payload, "content_length": len(block), "record": whole}
                    made.append(row)
            derived = pa.RecordBatch.from_pylist(made, schema=schema)
            ids = batch.column("page_id").take(pa.array(keys, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *derived.columns], ["page_id", *schema.names])

    fields = ", ".join(f"{name} string" for name in [*names, "source_digest"])
    return rows.mapInArrow(make, f"page_id {kind}, {fields}, content_length long, record binary, error string")
