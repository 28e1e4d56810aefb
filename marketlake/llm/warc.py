"""Derivatives of web archive records: metadata and plain text of each response, linked to it.

A response is a WARC record whose block is an HTTP message. Each one gives a metadata record (application/warc-fields:
status, source headers, digests, title, language, links) and, if its body is a text, a conversion record (text/plain,
UTF-8). Chunked framing and gzip or deflate codings are undone first; digests are those of the source. Records refer to the
response's id and carry its target and date. Ids follow from the source's id, so a task that runs again writes the same
records. Every row is handled on its own; nothing is shuffled.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import zlib
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RECORD = (
    "warc_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, "
    "content_length long, block_digest string, source_block_digest string, source_payload_digest string, "
    "http_status int, block string"
)

MAX_BODY = 64 << 20  # bytes that a compressed body may inflate to; more is cut and reported in the metadata record
MAX_BLOCK = 256 << 20  # bytes of a record's block; larger records are rejects
MAX_FILE = 1 << 30  # bytes of a file that is read as one value; larger files are rejects
_PIECE = 1 << 16  # bytes of a file that are decompressed at once
_MAX_HEAD = 1 << 20  # bytes of a record's headers
_MAGIC = b"\x1f\x8b\x08"

_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b[^<>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
_TITLE = re.compile(r"<title\b[^<>]*>(.*?)(?:</title\s*>|\Z)", re.S | re.I)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)([^<>]*)>|<[!?/][^<>]*>")
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_SPACE = re.compile(r"[ \t\r\f\v\xa0]+")
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)
_CHUNK = re.compile(rb"[ \t]*([0-9A-Fa-f]{1,15})[ \t]*(?:;[^\r\n]*)?\r\n")
_BINARY = re.compile(rb"[\x00-\x08\x0e-\x1a\x1c-\x1f]")
_MARKUP_TYPES = re.compile(r"text/html|(?:text|application)/(?:[\w.-]+\+)?xml")
_TEXT_TYPES = re.compile(r"text/.+|application/(?:[\w.-]+\+)?(?:json|javascript|ecmascript|x-javascript|x-ndjson)")
_BLOCK_TAGS = frozenset(
    "address article aside blockquote body br dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 header hr html li main nav ol p pre section table td th title tr ul".split()
)


def digest(data: bytes) -> str:
    """SHA-1 as archives write it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    """A name-based id, the same for the same parts."""
    h = hashlib.md5("\x1f".join(parts).encode("utf-8", "surrogatepass")).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-3{h[13:16]}-8{h[17:20]}-{h[20:]}>"


def parse_http(block: bytes) -> tuple[int | None, list[tuple[str, str]], bytes]:
    """Status, headers and body of a message; a block that is no message is all body."""
    if not block.startswith(b"HTTP/"):
        return None, [], block
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        head, _, body = block.partition(b"\n\n")
    lines = head.decode("utf-8", "replace").splitlines()
    status = re.match(r"HTTP/\S+ +(\d{3})", lines[0])
    headers = [(k.strip(), v.strip()) for k, colon, v in (line.partition(":") for line in lines[1:]) if colon]
    return int(status[1]) if status else None, headers, body


def _values(headers: list[tuple[str, str]], name: str) -> list[str]:
    """The comma-separated values of a header in lower case, in order."""
    return [v for k, values in headers if k.lower() == name for v in values.lower().replace(" ", "").split(",") if v]


def _unchunked(body: bytes) -> bytes:
    """The data of a chunked body; what is not framed so (archives may undo it) stays, a cut one gives what is there."""
    parts, at = [], 0
    while size := _CHUNK.match(body, at):
        at, length = size.end(), int(size[1], 16)
        if not length:
            return b"".join(parts)
        parts.append(body[at : at + length])
        at += length
        if at < len(body) and not body.startswith(b"\r\n", at):
            return body
        at += 2
    return b"".join(parts) if any(parts) and at >= len(body) else body


def _inflated(body: bytes, wbits: int, limit: int) -> bytes | None:
    """All members of a compressed body up to its end, a damaged place or one byte over the limit; None if it is not
    compressed so."""
    out, ended, unzip, room = [], False, zlib.decompressobj(wbits), limit + 1
    for at in range(0, len(body), 512):  # in pieces, since a damaged one gives nothing
        piece = body[at : at + 512]
        while piece:
            try:
                out.append(unzip.decompress(piece, room))
            except zlib.error:
                return b"".join(out) if ended or any(out) else None
            room -= len(out[-1])
            if not room:
                return b"".join(out)
            piece = unzip.unused_data
            if unzip.eof:
                ended, unzip = True, zlib.decompressobj(wbits)
                if wbits != 31:
                    return b"".join(out)
    return b"".join(out) if ended or any(out) else None


def content(headers: list[tuple[str, str]], body: bytes, limit: int = MAX_BODY) -> bytes | None:
    """The body without its transfer and content codings, or None if one of them can't be undone.

    What a coding may inflate to is bounded: of more than ``limit`` bytes the first ``limit`` + 1 come back. A body that is not coded as its headers say, as archives that store decoded bodies have them, is taken as it is.
    """
    for coding in reversed(_values(headers, "content-encoding") + _values(headers, "transfer-encoding")):
        if coding == "chunked":
            body = _unchunked(body)
        elif coding in ("gzip", "x-gzip"):
            body = _inflated(body, 31, limit) or b"" if body.startswith(b"\x1f\x8b") else body
        elif coding == "deflate":  # with or without the frame that it should have
            plain = _inflated(body, 15, limit)
            plain = _inflated(body, -15, limit) if plain is None else plain
            body = body if plain is None else plain
        elif coding != "identity" and _BINARY.search(body[:1024]):
            return None
    return body


def text_kind(headers: list[tuple[str, str]], body: bytes) -> str | None:
    """'markup', 'plain' or None (no text) by the type that the headers name; without one, by the first kilobyte."""
    named = next((v for k, v in headers if k.lower() == "content-type"), "").partition(";")[0].strip().lower()
    if not named:
        return None if _BINARY.search(body[:1024]) else "markup"
    return "markup" if _MARKUP_TYPES.fullmatch(named) else "plain" if _TEXT_TYPES.fullmatch(named) else None


def decode(body: bytes, headers: list[tuple[str, str]]) -> str:
    """The body as text, by the charset that its header or its first kilobyte names, else UTF-8."""
    named = [_CHARSET.search(v) for k, v in headers if k.lower() == "content-type"]
    named.append(_CHARSET.search(body[:1024].decode("latin-1")))
    for match in filter(None, named):
        try:
            return body.decode(match[1], "replace")
        except LookupError:
            continue
    return body.decode("utf-8", "replace")


def _line(text: str) -> str:
    return " ".join(html.unescape(text).split())


def read_page(page: str, base: str) -> tuple[str, str, list[str], str]:
    """Title, language, links (absolute, each once, in order) and plain text of a page."""
    page = _HIDDEN.sub(" ", page)
    title = _TITLE.search(page)
    body = _TITLE.sub("\n", page)
    language, links, parts, at = "", [], [], 0
    for tag in _TAG.finditer(body):
        parts.append(body[at : tag.start()])
        at = tag.end()
        name = (tag[2] or "").lower()
        if name in _BLOCK_TAGS:
            parts.append("\n")
        if name in ("a", "html") and not tag[1]:
            values = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(tag[3])}
            if name == "html":
                language = language or values.get("lang", "")
            elif values.get("href"):
                try:
                    links.append("".join(urljoin(base, values["href"].strip()).split()))
                except ValueError:  # no address
                    pass
    parts.append(body[at:])
    text = html.unescape("".join(parts))
    lines = (_SPACE.sub(" ", line).strip() for line in text.split("\n"))
    return _line(_TAG.sub("", title[1])) if title else "", language, list(dict.fromkeys(links)), "\n".join(filter(None, lines))


def derive_one(source_id: str, target: str | None, date: str | None, headers: dict[str, str], block: bytes) -> list[tuple]:
    """The metadata record of one response, and the conversion record if its body is a text."""
    status, http, body = parse_http(block)
    own = {k.lower(): v for k, v in headers.items() if v is not None}
    block_digest = own.get("warc-block-digest") or digest(block)
    payload_digest = own.get("warc-payload-digest") or digest(body)
    plain = content(http, body)
    codings = _values(http, "content-encoding") + _values(http, "transfer-encoding")
    cut = plain is not None and len(plain) == MAX_BODY + 1 and bool({"gzip", "x-gzip", "deflate"} & set(codings))
    plain = plain[:MAX_BODY] if cut else plain
    kind = None if plain is None else text_kind(http, plain)
    title, language, links, text = "", "", [], None
    if kind == "markup":
        title, language, links, text = read_page(decode(plain, http), target or "")
    elif kind == "plain":
        text = decode(plain, http)
    one_line = lambda v: " ".join(v.split())
    fields = [("source-record-id", source_id), ("source-block-digest", block_digest), ("source-payload-digest", payload_digest)]
    fields += [(f"source-{k.lower()}", v) for k, v in sorted(headers.items()) if v is not None]
    fields += [("http-status", str(status))] if status is not None else []
    fields += [(f"http-{k.lower()}", v) for k, v in http]
    fields += [("body-cut-at", str(MAX_BODY))] if cut else []
    fields += [("title", title)] if title else []
    fields += [("language", language)] if language else []
    fields += [("outlink", link) for link in links]
    described = "".join(f"{k}: {one_line(v)}\r\n" for k, v in fields)
    out = []
    for kind, content_type, written in (
        ("metadata", "application/warc-fields", described), ("conversion", "text/plain; charset=utf-8", text)
    ):
        if written is None:
            continue
        data = written.encode("utf-8", "surrogatepass")
        out.append((
            kind, record_id(kind, source_id), source_id, target, date, content_type, len(data), digest(data),
            block_digest, payload_digest, status, written,
        ))
    return out


def derivatives(responses: DataFrame) -> DataFrame:
    """Records for each row of ``responses`` (record_id, target_uri, warc_date, headers map, block binary): metadata, and
    a conversion of what is a text by its type.

    Other columns come before the records' own, with a clashing name left out. Null ids become an id made from
    the target and the block, a null block is empty, and null targets, dates and headers are left out of records.
    Rows that repeat an id give records that repeat theirs. An empty table gives no rows.
    """

    @F.pandas_udf(f"array<struct<{RECORD.replace(' string', ':string').replace(' long', ':long').replace(' int', ':int')}>>")
    def derive(ids: pd.Series, targets: pd.Series, dates: pd.Series, headers: pd.Series, blocks: pd.Series) -> pd.Series:
        names = [field.split()[0] for field in RECORD.split(", ")]
        out = []
        for source, target, date, head, block in zip(ids, targets, dates, headers, blocks):
            block = bytes(block or b"")
            source = source or record_id("response", target or "", digest(block))
            rows = derive_one(source, target, date, dict(head or {}), block)
            out.append([dict(zip(names, row)) for row in rows])
        return pd.Series(out, dtype=object)

    made = {field.split()[0] for field in RECORD.split(", ")}
    others = [c for c in responses.columns if c not in {"record_id", "target_uri", "warc_date", "headers", "block"} | made]
    records = responses.select(
        *[F.col(f"`{c}`") for c in others],
        F.explode(derive("record_id", "target_uri", "warc_date", "headers", "block")).alias("__llm_record"),
    )
    return records.select(*[F.col(f"`{c}`") for c in others], "__llm_record.*")


def responses_of_pages(pages: DataFrame, date: str) -> DataFrame:
    """Response records of crawled pages (page_id, url, html): an HTTP message around each page, crawled at ``date``.

    A null page is an empty body; a null url leaves the target out. Ids follow from id, url and page.
    """
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    ).cast("binary")
    name = F.md5(F.concat_ws(
        "\x1f", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce(F.col("url"), F.lit("")), F.md5(body)
    ).cast("binary"))
    part = lambda a, n: F.substring(name, a, n)
    identity: Column = F.concat(
        F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-3"), part(14, 3), F.lit("-8"), part(18, 3),
        F.lit("-"), part(21, 12), F.lit(">"),
    )
    headers = F.create_map(
        F.lit("WARC-Type"), F.lit("response"), F.lit("Content-Type"), F.lit("application/http; msgtype=response")
    )
    return pages.select(
        F.col("page_id").cast("long"), identity.alias("record_id"), F.col("url").cast("string").alias("target_uri"),
        F.lit(date).alias("warc_date"), headers.alias("headers"), F.concat(head, body).alias("block"),
    )


# Files -------------------------------------------------------------------------------------------------------------


def serialise(kind: str, identity: str, headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record as a gzip member; members in a row are a WARC file."""
    named = [("WARC-Type", kind), ("WARC-Record-ID", identity), *headers, ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in named if v is not None)
    return gzip.compress(f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n", mtime=0)


def members(records: DataFrame) -> DataFrame:
    """The records of ``derivatives`` with ``member``: the record's bytes in a WARC file."""

    @F.pandas_udf("binary")
    def member(kind: pd.Series, identity: pd.Series, refers: pd.Series, target: pd.Series, date: pd.Series,
               content: pd.Series, block_digest: pd.Series, block: pd.Series) -> pd.Series:
        out = []
        for k, i, r, t, d, c, b, text in zip(kind, identity, refers, target, date, content, block_digest, block):
            headers = [("WARC-Refers-To", r), ("WARC-Target-URI", t), ("WARC-Date", d), ("Content-Type", c),
                       ("WARC-Block-Digest", b)]
            out.append(serialise(k, i, headers, text.encode("utf-8", "surrogatepass")))
        return pd.Series(out, dtype=object)

    return records.withColumn("member", member(
        "warc_type", "record_id", "refers_to", "target_uri", "warc_date", "content_type", "block_digest", "block"
    ))


class _Plain:
    """A file's bytes, decompressed piece by piece as they are asked for."""

    def __init__(self, content: bytes):
        self.content, self.at, self.buffer, self.damage = memoryview(content), 0, bytearray(), None
        self.unzip = zlib.decompressobj(31) if bytes(self.content[:3]) == _MAGIC else None

    def more(self) -> bool:
        """Add a piece to the buffer; False at the file's end or where it is damaged."""
        if self.damage or self.at >= len(self.content):
            return False
        piece = bytes(self.content[self.at : self.at + _PIECE])
        if self.unzip is None:
            self.buffer += piece
            self.at += len(piece)
            return True
        if self.unzip.eof:  # the next member, padding, or something else
            if not piece.strip(b"\0"):
                self.at += len(piece)
                return self.more()
            if not piece.startswith(_MAGIC[: len(piece)]):
                self.damage = "bytes after the last member"
                return False
            self.unzip = zlib.decompressobj(31)
        try:
            out = self.unzip.decompress(piece, 16 * _PIECE)
        except zlib.error:
            self.damage = "damaged member"
            return False
        self.at += len(piece) - len(self.unzip.unused_data) - len(self.unzip.unconsumed_tail)
        self.buffer += out
        if self.at >= len(self.content) and not self.unzip.eof:
            self.damage = "cut member"
        return True

    def resume(self) -> None:
        """Go on at the next member after a damaged place, without what the damaged one gave."""
        rest = bytes(self.content[self.at + 1 :])
        found = rest.find(_MAGIC)
        self.at = len(self.content) if found < 0 else self.at + 1 + found
        self.buffer.clear()
        self.unzip, self.damage = zlib.decompressobj(31), None


def parse_records(content: bytes, max_block: int = MAX_BLOCK) -> Iterator[tuple[str | None, dict[str, str], bytes]]:
    """(reason, headers, block) of every record of a WARC file, plain or gzipped, one after the other.

    The reason is None for good records, else why a place gives none: ``bad length``, ``too large``, ``no end of headers``,
    ``cut record``, or how the compression is damaged. Reading goes on behind it: at the next record, or at the next
    member of a compressed file. Zero padding is no damage. Memory holds the file, one record and a piece.
    """
    source = _Plain(content)
    buffer = source.buffer

    def fill(size: int) -> bool:
        while len(buffer) < size:
            if not source.more():
                return False
        return True

    while True:
        start = buffer.find(b"WARC/")
        if start < 0:
            del buffer[:-4]
            if source.more():
                continue
            if source.damage:
                yield source.damage, {}, b""
                source.resume()
                continue
            return
        del buffer[:start]
        end = buffer.find(b"\r\n\r\n")
        while end < 0 and len(buffer) < _MAX_HEAD and source.more():
            end = buffer.find(b"\r\n\r\n")
        if end < 0:
            reason = source.damage or "no end of headers"
            yield reason, {}, b""
            if source.damage:
                source.resume()
            del buffer[:5]
            continue
        lines = buffer[:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip(): v.strip() for k, colon, v in (line.partition(":") for line in lines) if colon}
        length = next((v for k, v in headers.items() if k.lower() == "content-length"), "0")
        del buffer[: end + 4]
        if not re.fullmatch(r"[0-9]{1,18}", length):
            yield "bad length", headers, b""
            continue
        left = int(length)
        if left > max_block:
            yield "too large", headers, b""
            while left and (buffer or source.more()):
                gone = min(left, len(buffer))
                del buffer[:gone]
                left -= gone
        elif fill(left):
            yield None, headers, bytes(buffer[:left])
            del buffer[:left]
        else:
            yield source.damage or "cut record", headers, b""
            if source.damage:
                source.resume()
            buffer.clear()


def parse_file(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every good record of a WARC file."""
    return ((headers, block) for reason, headers, block in parse_records(content) if reason is None)


_READ = (
    "path string, reason string, record_id string, target_uri string, warc_date string, headers map<string,string>, block binary"
)


def read_archive(files: DataFrame, max_file: int = MAX_FILE) -> DataFrame:
    """Responses and rejects of WARC files, as the binaryFile source gives them (path, length, content).

    Response records have no ``reason``; a reject has one, its path and what headers it has, but no block. Files of more
    than ``max_file`` bytes are rejects as a whole, whose content is not read. A damaged file gives all records that
    can be read, and never ends the job.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in _READ.split(", ")]
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                for reason, headers, block in parse_records(bytes(content)):
                    known = {k.lower(): v for k, v in headers.items()}
                    if reason is not None or known.get("warc-type") == "response":
                        yield pd.DataFrame([(
                            path, reason, known.get("warc-record-id"), known.get("warc-target-uri"), known.get("warc-date"),
                            headers, block if reason is None else None,
                        )], columns=names)

    whole = files.where(F.col("length") <= max_file).select("path", "content").mapInPandas(run, _READ)
    large = files.where(F.col("length") > max_file).select(
        "path", F.lit("file too large").alias("reason"), *[F.lit(None).cast("string").alias(c) for c in (
            "record_id", "target_uri", "warc_date")], F.lit(None).cast("map<string,string>").alias("headers"),
        F.lit(None).cast("binary").alias("block"),
    )
    return whole.union(large)


def read_responses(files: DataFrame) -> DataFrame:
    """Response records of WARC files, see :func:`read_archive`."""
    return read_archive(files).where("reason IS NULL").drop("path", "reason")


def reject_counts(archive: DataFrame) -> DataFrame:
    """(path, reason, n) of what :func:`read_archive` could not read."""
    return archive.where("reason IS NOT NULL").groupBy("path", "reason").agg(F.count("*").alias("n"))
