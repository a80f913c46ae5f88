"""WARC derivative builder (operator 4): responses become metadata and conversion records.

For every response record two records are derived: one of type ``metadata``, whose
block lists the source's HTTP status and headers and its digests as warc-fields, and
one of type ``conversion`` with the plain text of the page. Both name the response in
WARC-Refers-To, with its target URI and date, and each other in WARC-Concurrent-To.
Identifiers are name-based, so that a rerun gives the same records.

Response records come from a table of pages (``responses``) or from WARC files of any
writer (``read_records``, ``responses_of``). A payload's chunks are joined and gzip and
deflate are undone; its characters are read by the charset of Content-Type, else by a
byte order mark or the page's own ``meta``, else as UTF-8.

Records are rows; ``write_records`` writes them as gzip WARC files with Spark's text
writer, one gzip stream a file. ``read_records`` finds the end of a block by
Content-Length, so a block may hold any bytes, a record's start among them. Tasks hold
one record at a time; a gzip file is read by one task.

Defined results: a NULL html is an empty payload and gives an empty conversion block; a
NULL or empty URL leaves WARC-Target-URI out; line ends in a URL are percent-encoded; a
payload that is no text, or in a coding that cannot be undone, gives an empty conversion
block; an unknown charset counts as UTF-8 and wrong bytes become U+FFFD; a body that is
not chunked as its header says is taken as it is; long texts are converted whole;
repeated rows give repeated records with the same identifiers; further columns do not
matter; an empty table gives no records. A file that ends inside a record is an error.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import uuid
import zlib
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The functions of tasks travel with the job, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CRLF = "\r\n"
END = CRLF + CRLF
VERSION = "WARC/1.0"
_START = b"WARC/1."
_LENGTH = re.compile(r"\r\ncontent-length:[ \t]*(\d+)", re.I)
READ = "headers string, block binary"
RESPONSE = "page_id long, record_id string, target_uri string, date string, block_digest string, payload_digest string, headers string, block binary"
DERIVED = (
    "page_id long, record_id string, warc_type string, refers_to string, concurrent_to string, target_uri string, date string, "
    "content_type string, content_length long, block_digest string, payload_digest string, headers string, block string"
)
# Quoted values may have any length. A tag without an end is taken out as far as it goes, so that no part is read for each of many tags.
_INSIDE = r"(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+"
_MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b{_INSIDE}>.*?(?:</\1\s*+>|\Z)|</?([a-zA-Z!?]\w*+){_INSIDE}(>?)", re.S | re.I
)
_BREAKS = frozenset(
    "address article aside blockquote body br dd div dl dt figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre "
    "section table td th title tr ul".split()
)
_CHARSET = re.compile(r"charset\s*=\s*[\"']?\s*([\w.:-]+)", re.I)
_META = re.compile(rb"<meta\b[^>]*?charset\s*=\s*[\"']?\s*([\w.:-]+)", re.I)
_SIZE = re.compile(rb"\s*([0-9a-fA-F]+)[^\r\n]*\r?\n")
# Where a page may name its charset, as browsers look for it.
META_WITHIN = 1024
MARKS = ((b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be"))
_BLANK = re.compile(r"[^\S\n]+")
_LINES = re.compile(r"\s*\n\s*")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, repr(parts))}>"


def head_of(*fields: tuple[str, object]) -> str:
    """The version line and the fields that have a value."""
    return CRLF.join([VERSION, *(f"{name}: {value}" for name, value in fields if value is not None)])


def plain_text(html: str) -> str:
    """Visible text of a page, one block a line."""
    text = _MARKUP.sub(lambda m: "\n" if m[3] and m[2].lower() in _BREAKS else " ", html)
    return _LINES.sub("\n", _BLANK.sub(" ", unescape(text))).strip()


def _dechunked(body: bytes) -> bytes:
    """The chunks of a body joined; the body itself where it does not start with a chunk's size."""
    parts, at = [], 0
    while (size := _SIZE.match(body, at)) and (n := int(size[1], 16)):
        parts.append(body[size.end() : size.end() + n])
        at = size.end() + n
    return b"".join(parts) if parts or size else body


def _uncoded(body: bytes, coding: str) -> bytes | None:
    """``body`` without its content codings, None where one cannot be undone."""
    for name in reversed([c.strip().lower() for c in coding.split(",")]):
        if name in ("gzip", "x-gzip", "deflate"):
            for window in (47, -15):
                try:
                    # A cut body gives what it holds.
                    body = zlib.decompressobj(window).decompress(body)
                    break
                except zlib.error:
                    continue
            else:
                return None
        elif name not in ("", "identity"):
            return None
    return body


def _decoded(body: bytes, named: str | None) -> str:
    mark = next(((m, name) for m, name in MARKS if body.startswith(m)), None)
    if mark:
        body, named = body[len(mark[0]) :], mark[1]
    elif not named and (meta := _META.search(body[:META_WITHIN])):
        named = meta[1].decode()
    # On the web Latin-1 stands for the Windows table, which has more characters.
    named = "cp1252" if (named or "").lower() in ("iso-8859-1", "latin1", "latin-1", "ascii", "us-ascii") else named or "utf-8"
    try:
        return body.decode(named, "replace")
    except (LookupError, UnicodeError):
        return body.decode("utf-8", "replace")


def conversion(head: list[str], payload: bytes) -> str:
    """Plain text of an HTTP payload, given its header lines."""
    fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in head)}
    kind = fields.get("content-type", "")
    mime = kind.partition(";")[0].strip().lower() or "text/html"
    if not (mime.startswith("text/") or mime.endswith(("xml", "json"))):
        return ""
    if "chunked" in fields.get("transfer-encoding", "").lower():
        payload = _dechunked(payload)
    body = _uncoded(payload, fields.get("content-encoding", ""))
    if body is None:
        return ""
    charset = _CHARSET.search(kind)
    text = _decoded(body, charset[1] if charset else None)
    return plain_text(text) if mime.endswith(("html", "html+xml", "xml")) else _LINES.sub("\n", text).strip()


def responses(pages: DataFrame) -> DataFrame:
    """Response records of a table ``page_id, url, html``, which keeps no HTTP headers of its own.

    The date is derived from ``page_id``, in seconds after the start of 2025.
    """
    at = F.date_format(F.timestamp_seconds(F.lit(1735689600) + F.coalesce(F.col("page_id"), F.lit(0)) % 31536000), "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page, url, date, html in zip(*(c.to_pylist() for c in batch.columns)):
                payload = (html or "").encode()
                head = CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"])
                block = (head + END).encode() + payload
                uri = url.replace("\r", "%0D").replace("\n", "%0A") if url else None
                own, whole, part = record_id("response", page, url), digest(block), digest(payload)
                headers = head_of(
                    ("WARC-Type", "response"), ("WARC-Record-ID", own), ("WARC-Target-URI", uri), ("WARC-Date", date),
                    ("WARC-Block-Digest", whole), ("WARC-Payload-Digest", part),
                    ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block)),
                )
                rows.append((page, own, uri, date, whole, part, headers, block))
            yield _batch(rows, [pa.int64(), *[pa.string()] * 6, pa.binary()], RESPONSE)

    return pages.select("page_id", "url", at.alias("at"), "html").mapInArrow(run, RESPONSE)


def _batch(rows: list[tuple], types: list[pa.DataType], schema: str) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [f.split()[0] for f in schema.split(", ")])


def derivatives(records: DataFrame) -> DataFrame:
    """Two rows for each response record, in the columns of DERIVED."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page, source, uri, date, whole, part, block in zip(*(c.to_pylist() for c in batch.columns)):
                head, _, payload = block.partition(END.encode())
                status, *fields = head.decode("utf-8", "replace").split(CRLF)
                text = conversion(fields, payload)
                meta_id, text_id = record_id("metadata", source), record_id("conversion", source)
                listed = [("http-status", status), *(("http-header", f) for f in fields), ("source-block-digest", whole), ("source-payload-digest", part), ("conversion", text_id)]
                facts = "".join(f"{name}: {value}{CRLF}" for name, value in listed if value is not None)
                for kind, own, other, mime, body in (("metadata", meta_id, text_id, "application/warc-fields", facts), ("conversion", text_id, meta_id, "text/plain; charset=utf-8", text)):
                    data = body.encode()
                    mark = digest(data)
                    headers = head_of(
                        ("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Refers-To", source), ("WARC-Refers-To-Target-URI", uri),
                        ("WARC-Refers-To-Date", date), ("WARC-Concurrent-To", other), ("WARC-Target-URI", uri), ("WARC-Date", date),
                        ("WARC-Block-Digest", mark), ("Content-Type", mime), ("Content-Length", len(data)),
                    )
                    rows.append((page, own, kind, source, other, uri, date, mime, len(data), mark, part, headers, body))
            yield _batch(rows, [pa.int64(), *[pa.string()] * 7, pa.int64(), *[pa.string()] * 4], DERIVED)

    columns = ["page_id", "record_id", "target_uri", "date", "block_digest", "payload_digest", "block"]
    return records.select(*columns).mapInArrow(run, DERIVED)


def write_records(records: DataFrame, path: str) -> None:
    """Records as gzip WARC files: header, blank line, block, and two line ends after each."""
    # The text writer writes the bytes of a string as they are.
    whole = F.concat("headers", F.lit(END), F.col("block").cast("binary").cast("string")).alias("value")
    records.select(whole).write.option("lineSep", END).option("compression", "gzip").text(path)


def _framed(pieces: Iterator[tuple[object, bytes]]) -> Iterator[tuple[str, bytes]]:
    """Header and block of each record, of pieces in file order that start where a record may start."""
    file = head = None
    parts: list[bytes] = []
    held = need = 0
    for name, piece in pieces:
        if parts and name != file:
            raise ValueError(f"{file}: ends inside a record")
        # Later pieces have lost the separator that stood before them.
        piece = piece if name != file else (CRLF if parts else "").encode() + _START + piece
        file = name
        parts.append(piece)
        held += len(piece)
        if head is None:
            data = b"".join(parts)
            fields, end, rest = data.partition(END.encode())
            if not end:
                continue
            head = fields.decode("utf-8", "replace")
            length = _LENGTH.search(head)
            if not length:
                raise ValueError(f"{file}: a record without Content-Length")
            parts, held, need = [rest], len(rest), int(length[1])
        if held >= need:
            yield head, b"".join(parts)[:need]
            head, parts, held = None, [], 0
    if parts:
        raise ValueError(f"{file}: ends inside a record")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``headers string, block binary`` of gzip WARC files, of one gzip member or many."""
    lines = spark.read.option("lineSep", CRLF + _START.decode()).text(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = ((f, v) for b in batches for f, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        for head, block in _framed(pieces):
            yield _batch([(head, block)], [pa.string(), pa.binary()], READ)

    # A task reads its files one after the other, in their order.
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value")).mapInArrow(run, READ)


def responses_of(records: DataFrame) -> DataFrame:
    """The responses among ``headers, block``, in the columns of RESPONSE without ``page_id``."""

    def field(name: str) -> Column:
        return F.nullif(F.regexp_extract("headers", rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1), F.lit(""))

    names = {"record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date", "block_digest": "WARC-Block-Digest", "payload_digest": "WARC-Payload-Digest"}
    found = records.where(F.lower(field("WARC-Type")) == "response")
    return found.select(F.lit(None).cast("long").alias("page_id"), *(field(name).alias(column) for column, name in names.items()), "headers", "block")
