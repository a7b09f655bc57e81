"""Derivatives of WARC responses: a metadata record and a plain-text conversion record for each.

Both refer to the response by its record id and to each other, carry its URI and date, and have digests of their own.
The metadata keep the source's HTTP headers, its digests, and what the page says of itself.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relocate.llm import shipped

RESPONSE = "record_id string, target_uri string, date string, payload_digest string, block binary"
RECORD = (
    "record_type string, record_id string, refers_to string, concurrent_to string, target_uri string, date string, "
    "content_type string, content_length long, block_digest string, content string"
)
# Elements whose content is not shown, and those that end a line.
_UNSEEN = frozenset("script style noscript template".split())
_BREAKS = frozenset(
    "address article aside blockquote body br dd div dl dt figure footer form h1 h2 h3 h4 h5 h6 head header hr html li "
    "main nav ol p pre section table td th title tr ul".split()
)
_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_CLOSING = {name: re.compile(rf"</{name}\s*>", re.I) for name in (*_UNSEEN, "title")}
_QUOTE_OR_END = re.compile("[\"'>]")
_ATTRIBUTE = re.compile(r"([^\s=>\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_CHARSET = re.compile(rb"charset\s*=\s*[\"']?([\w-]+)", re.I)
_BLANKS = re.compile(r"[^\S\n]+")
_HEAD_END = re.compile(rb"\r?\n\r?\n")
_CHUNK = re.compile(rb"(?:\r?\n)?([0-9a-fA-F]{1,12})(?:;[^\r\n]*)?\r?\n")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*what: str) -> str:
    """An id that is the same whenever the record is made from the same source."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(chr(31).join(what).encode()).digest()[:16], version=5)}>"


@dataclass(frozen=True)
class Tag:
    """``page[start:end]``: a tag, or something that is not shown, which has no name."""

    start: int
    end: int
    name: str = ""
    closing: bool = False
    inside: str = ""  # what follows the name

    def attribute(self, name: str) -> str | None:
        for m in _ATTRIBUTE.finditer(self.inside):
            if m[1].lower() == name:
                return html.unescape(m[2] or m[3] or m[4] or "")
        return None


def tags(page: str) -> Iterator[Tag]:
    """Tags of a page in order, comments, declarations and unseen elements among them as nameless ones.

    Reads forwards only. A tag ends at the first ``>`` outside quotes; a quote that is never closed is an ordinary
    character. Where nothing ends a tag any more, the rest of the page is text. An unclosed comment or unseen element
    goes on to the end of the page.
    """
    at, quoting = 0, True
    while (start := page.find("<", at)) >= 0:
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            yield Tag(start, at := len(page) if end < 0 else end + 3)
            continue
        if page.startswith(("<!", "<?"), start):
            end = page.find(">", start)
            if end < 0:
                return
            yield Tag(start, at := end + 1)
            continue
        named = _NAME.match(page, start + 1)
        if not named:
            at = start + 1
            continue
        end = _tag_end(page, named.end()) if quoting else -1
        if end < 0:
            # no tag from here on ends outside quotes: they are no quotes
            quoting, end = False, page.find(">", named.end())
            if end < 0:
                return
        name, closing = named[1].lower(), page[start + 1] == "/"
        at = end + 1
        if name in _UNSEEN and not closing:
            over = _CLOSING[name].search(page, at)
            at = over.end() if over else len(page)
            yield Tag(start, at)
        else:
            yield Tag(start, at, name, closing, page[named.end() : end])


def _tag_end(page: str, at: int) -> int:
    """Place of the first ``>`` outside quotes, -1 if there is none."""
    open_quotes = set()
    while found := _QUOTE_OR_END.search(page, at):
        if found[0] == ">":
            return found.start()
        at = found.end()
        if found[0] not in open_quotes:
            close = page.find(found[0], at)
            if close < 0:
                open_quotes.add(found[0])
            else:
                at = close + 1
    return -1


def plain_text(page: str, found: list[Tag] | None = None) -> str:
    """The words of a page, a line for each block; scripts, styles and comments are left out."""
    pieces, at = [], 0
    for tag in tags(page) if found is None else found:
        pieces += [page[at : tag.start], "\n" if tag.name in _BREAKS else ""]
        at = tag.end
    shown = html.unescape("".join(pieces) + page[at:])
    lines = (_BLANKS.sub(" ", line).strip() for line in shown.split("\n"))
    return "\n".join(line for line in lines if line)


def described(page: str, found: list[Tag], url: str) -> list[tuple[str, str]]:
    """What a page says of itself: title, language and outlinks, in order."""
    fields = []
    title = next((t for t in found if t.name == "title" and not t.closing), None)
    over = _CLOSING["title"].search(page, title.end) if title else None
    if over:
        fields.append(("title", " ".join(html.unescape(page[title.end : over.start()]).split())))
    lang = next((t.attribute("lang") for t in found if t.name == "html" and not t.closing), None)
    fields += [("language", lang)] if lang else []
    for tag in found:
        if tag.name in ("a", "area") and not tag.closing and (link := tag.attribute("href")) is not None:
            fields.append(("outlink", _joined(url, link)))
    return fields


def split_response(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload of an HTTP response; without a header block all of it is payload."""
    over = _HEAD_END.search(block)
    if not block.startswith(b"HTTP/") or not over:
        return "", [], block
    status, *lines = re.split("\r?\n", block[: over.start()].decode("latin-1"))
    return status, [(n.strip(), v.strip()) for n, c, v in (line.partition(":") for line in lines) if c], block[over.end() :]


def content_of(payload: bytes, headers: dict[str, str]) -> bytes | None:
    """The payload without its transfer and content encodings; None where one is unknown.

    What is not encoded as the headers say, as in records whose encodings were undone, stays as it is.
    """
    if "chunked" in headers.get("transfer-encoding", "").lower():
        payload = _unchunked(payload)
    for encoding in reversed([e.strip().lower() for e in headers.get("content-encoding", "").split(",")]):
        if encoding in ("gzip", "x-gzip", "deflate"):
            payload = _inflated(payload, encoding)
        elif encoding not in ("", "identity"):
            return None
    return payload


def _unchunked(payload: bytes) -> bytes:
    out, at = [], 0
    while size := _CHUNK.match(payload, at):
        begin, length = size.end(), int(size[1], 16)
        if not length:
            return b"".join(out)
        out.append(payload[begin : begin + length])
        at = begin + length
    return b"".join(out) if out and at >= len(payload) else payload


def _inflated(payload: bytes, encoding: str) -> bytes:
    for bits in (47,) if encoding != "deflate" else (47, -15):
        unpack, rest, out = zlib.decompressobj(bits), payload, []
        try:
            while rest:
                out.append(unpack.decompress(rest))
                # further gzip members follow one another
                rest, unpack = unpack.unused_data, zlib.decompressobj(bits)
            return b"".join(out)
        except zlib.error:
            if out:
                return b"".join(out)
    return payload


def _decoded(payload: bytes, content_type: str) -> tuple[str, str]:
    named = _CHARSET.search(content_type.encode()) or _CHARSET.search(payload[:2048])
    charset = named[1].decode().lower() if named else "utf-8"
    try:
        return payload.decode(charset, "replace"), charset
    except LookupError:
        return payload.decode("utf-8", "replace"), "utf-8"


def derivatives(source: dict) -> list[dict]:
    """Metadata and conversion of one response. A payload that is no text, or in an unknown encoding, has metadata alone."""
    status, headers, payload = split_response(source["block"] or b"")
    of_name = {n.lower(): v for n, v in headers}
    kind = of_name.get("content-type", "text/html")
    url, own = source["target_uri"] or "", source["record_id"] or ""
    ids = record_id("metadata", own, url), record_id("conversion", own, url)
    textual = kind.lower().startswith(("text/", "application/xhtml"))
    content = content_of(payload, of_name) if textual else None
    textual = content is not None
    page, charset = _decoded(content, kind) if textual else ("", "")
    marked = textual and not kind.lower().startswith("text/plain")
    fields = [("source-record-id", own), ("source-block-digest", digest(source["block"] or b""))]
    fields.append(("source-payload-digest", source["payload_digest"] or digest(payload)))
    fields += [("http-status", status)] if status else []
    fields += [(f"http-header-{n.lower()}", v) for n, v in headers]
    fields += [("charset", charset)] if charset else []
    found = list(tags(page)) if marked else []
    fields += described(page, found, url) if marked else []
    lines = "".join(f"{n}: {_BLANKS.sub(' ', v.replace(chr(10), ' '))}\r\n" for n, v in fields)
    out = [_record("metadata", ids[0], ids[1] if textual else None, source, "application/warc-fields", lines)]
    if textual:
        out.append(_record("conversion", ids[1], ids[0], source, "text/plain; charset=UTF-8", plain_text(page, found) if marked else page))
    return out


def _joined(base: str, link: str) -> str:
    try:
        return urljoin(base, link.strip())
    except ValueError:
        return link.strip()


def _record(kind: str, own: str, other: str | None, source: dict, content_type: str, content: str) -> dict:
    data = content.encode("utf-8", "replace")
    return {
        "record_type": kind, "record_id": own, "refers_to": source["record_id"], "concurrent_to": other,
        "target_uri": source["target_uri"], "date": source["date"], "content_type": content_type,
        "content_length": len(data), "block_digest": digest(data), "content": data.decode(),
    }


def responses(pages: DataFrame, date: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Response records of a table of pages: ``id_col`` and the columns of ``RESPONSE``.

    Pages are taken as fetched at ``date`` with status 200, in UTF-8. A null page has an empty payload. Pages of the
    same id and URL have the same record id.
    """
    page = F.coalesce(pages[html_col], F.lit("")).cast("binary")
    name = F.sha2(F.concat_ws("\x1f", pages[id_col].cast("string"), pages[url_col]), 256)
    part = lambda a, n: F.substring(name, a, n)
    own = F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-a"), part(18, 3), F.lit("-"), part(21, 12), F.lit(">"))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(page).cast("string"), F.lit("\r\n\r\n")
    )
    return pages.select(
        pages[id_col],
        own.alias("record_id"),
        pages[url_col].alias("target_uri"),
        F.lit(date).alias("date"),
        F.lit(None).cast("string").alias("payload_digest"),
        F.concat(head.cast("binary"), page).alias("block"),
    )


def derived(sources: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records derived from responses with the columns of ``RESPONSE``: ``keep`` and the columns of ``RECORD``.

    Each response gives a metadata record and, when it is text, a conversion record; repeated responses give repeated
    records. An empty or null payload gives an empty conversion, null ids and URIs stay null, bytes that do not fit
    the charset become U+FFFD. An empty table gives no rows; other columns are ignored.
    """
    shipped(sources.sparkSession)
    names = [c.split()[0] for c in RESPONSE.split(", ")]
    kept = sources.select(*[sources[c] for c in keep]).schema
    made = [c.split()[0] for c in RECORD.split(", ")]
    schema = sources.sparkSession.createDataFrame([], RECORD).schema

    def derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, owner = [], []
            columns = [batch[f"_s_{c}"] for c in names]
            for i in range(batch.num_rows):
                found = derivatives({c: column[i].as_py() for c, column in zip(names, columns)})
                rows += found
                owner += [i] * len(found)
            taken = [batch[c].take(pa.array(owner, pa.int64())) for c in keep]
            types = {"content_length": pa.int64()}
            new = [pa.array([r[c] for r in rows], types.get(c, pa.string())) for c in made]
            yield pa.RecordBatch.from_arrays([*taken, *new], [*keep, *made])

    for field in schema:
        kept = kept.add(field)
    return sources.select(*[sources[c] for c in keep], *[sources[c].alias(f"_s_{c}") for c in names]).mapInArrow(derive, kept)


def as_text(records: DataFrame) -> DataFrame:
    """One column ``warc``: each record as it stands in a file, but for its last line end."""
    def line(name, value):
        # a line end in a value would begin another header
        value = F.regexp_replace(value.cast("string"), "[\r\n]+", " ")
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")

    column = F.col
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", column("record_type")),
        line("WARC-Record-ID", column("record_id")),
        line("WARC-Refers-To", column("refers_to")),
        line("WARC-Concurrent-To", column("concurrent_to")),
        line("WARC-Target-URI", column("target_uri")),
        line("WARC-Date", column("date")),
        line("WARC-Block-Digest", column("block_digest")),
        line("Content-Type", column("content_type")),
        line("Content-Length", column("content_length")),
    )
    return records.select(F.concat(head, F.lit("\r\n"), column("content"), F.lit("\r\n")).alias("warc"))


def write(records: DataFrame, folder: str) -> None:
    """Write records to gzip-compressed WARC files, one for each task."""
    as_text(records).write.option("lineSep", "\r\n").option("compression", "gzip").text(folder)


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, in lower case, and blocks of the records of a file; gzip members are unpacked as they come."""
    stream = gzip.open(io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, stream.read(int(headers.get("content-length", 0)))


def read(spark: SparkSession, path: str, kind: str = "response") -> DataFrame:
    """Records of one type from WARC files, as the columns of ``RESPONSE`` and ``record_type``, a task for some files."""
    shipped(spark)
    columns = {"record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date", "payload_digest": "warc-payload-digest"}

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                for headers, block in parsed(content.as_py()):
                    if headers.get("warc-type") == kind:
                        row = {c: pa.array([headers.get(h)], pa.string()) for c, h in columns.items()}
                        yield pa.RecordBatch.from_pydict(row | {"block": pa.array([block], pa.binary()), "record_type": pa.array([kind])})

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(split, f"{RESPONSE}, record_type string")
