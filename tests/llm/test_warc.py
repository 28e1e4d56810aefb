"""Derivatives of WARC responses: links between records, texts against an independent parser, round trips."""

import base64
import gzip
import hashlib
import zlib
from html.parser import HTMLParser

from pyspark.sql import functions as F

from marketlake.llm import queries, warc

SF = "/root/testdata/sf0.01"
PAGE = (
    "<!DOCTYPE html><html lang='fr'><head><title>A &amp; B\n c</title><style>p{}</style><script>var t='</p>';</script></head>"
    "<body><p>One&nbsp;two <b>three</b><br>four<!-- no --><ul><li><a href='/x?a=1&amp;b=2'>L</a><li><a href=\"y\">M</a>"
    "<a href=/x?a=1&b=2>again</a></ul> 1 < 2 &eacute;</body></html>"
)


class Plain(HTMLParser):
    def __init__(self):
        super().__init__()
        self.words, self.hidden, self.links = [], 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "title")
        if tag == "a" and dict(attrs).get("href"):
            self.links.append(dict(attrs)["href"])
        if tag in warc._BLOCK_TAGS:
            self.words.append("\n")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "title")
        if tag in warc._BLOCK_TAGS:
            self.words.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.words.append(data)


def b32(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_a_page():
    title, language, links, text = warc.read_page(PAGE, "http://a.example/d/")
    assert (title, language) == ("A & B c", "fr")
    assert links == ["http://a.example/x?a=1&b=2", "http://a.example/d/y"]
    assert text == "One two three\nfour\nL\nMagain\n1 < 2 é"


def test_unclosed_and_odd_pages():
    assert warc.read_page("", "")[3] == ""
    assert warc.read_page("a<script>never closed", "")[3] == "a"
    assert warc.read_page("a<!-- never closed", "")[3] == "a"
    assert warc.read_page("<" * 20000 + "x", "")[3].endswith("x")
    assert warc.read_page("<a href='http://[bad'>x</a>", "http://b/")[2:] == ([], "x")
    assert warc.read_page("x " * 200000, "")[3].count("x") == 200000


def test_messages():
    assert warc.parse_http(b"HTTP/1.1 404 No\r\nA: b: c\r\n\r\nbody\r\n\r\n") == (404, [("A", "b: c")], b"body\r\n\r\n")
    assert warc.parse_http(b"no message") == (None, [], b"no message")
    assert warc.decode("é".encode("latin-1"), [("content-type", "text/html; charset=ISO-8859-1")]) == "é"
    assert warc.decode("é".encode("latin-1") + b"<meta charset='latin1'>", [])[0] == "é"
    assert warc.decode("é".encode(), [("Content-Type", "x; charset=nonsense")]) == "é"


def test_records_are_linked_and_keep_headers_and_digests(spark):
    body = PAGE.encode()
    block = b"HTTP/1.1 200 OK\r\nServer: s\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + body
    rows = [("<urn:uuid:1>", "http://a.example/", "2020-01-01T00:00:00Z", {"WARC-IP-Address": "1.2.3.4", "X": None}, block, 5, "c"),
            ("<urn:uuid:2>", None, None, {"WARC-Payload-Digest": "sha1:GIVEN"}, None, 6, "c"),
            (None, "http://b.example/", None, None, b"bare", 7, "c")]
    schema = ("record_id string, target_uri string, warc_date string, headers map<string,string>, block binary, page_id long,"
              " http_status string")
    out = warc.derivatives(spark.createDataFrame(rows, schema))
    assert out.columns[:2] == ["page_id", "warc_type"]
    got = {(r.page_id, r.warc_type): r for r in out.collect()}
    assert len(got) == 6 and len({r.record_id for r in got.values()}) == 6
    meta, text = got[5, "metadata"], got[5, "conversion"]
    assert meta.refers_to == text.refers_to == "<urn:uuid:1>" and text.target_uri == "http://a.example/"
    assert text.source_block_digest == b32(block) and text.source_payload_digest == b32(body)
    lines = meta.block.split("\r\n")
    for line in ("source-record-id: <urn:uuid:1>", "source-warc-ip-address: 1.2.3.4", "http-status: 200", "http-server: s",
                 "title: A & B c", "language: fr", "outlink: http://a.example/y"):
        assert line in lines
    for r in got.values():
        assert r.content_length == len(r.block.encode()) and r.block_digest == b32(r.block.encode())
    assert got[6, "conversion"].block == "" and got[6, "metadata"].source_payload_digest == "sha1:GIVEN"
    assert got[7, "conversion"].block == "bare" and got[7, "metadata"].refers_to.startswith("<urn:uuid:")


def test_files_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a.example/", PAGE), (1, "http://a.example/", PAGE), (2, None, None)],
                                  "page_id long, url string, html string")
    responses = warc.responses_of_pages(pages, "2024-01-01T00:00:00Z").collect()
    content = b"".join(
        warc.serialise("response", r.record_id, [("WARC-Target-URI", r.target_uri), ("WARC-Date", r.warc_date)], bytes(r.block))
        for r in responses
    )
    (tmp_path / "a.warc.gz").write_bytes(content)
    read = warc.read_responses(spark.read.format("binaryFile").load(str(tmp_path)))
    assert sorted((r.record_id, bytes(r.block)) for r in read.collect()) == sorted((r.record_id, bytes(r.block)) for r in responses)
    made = warc.members(warc.derivatives(read)).collect()
    parsed = list(warc.parse_file(b"".join(bytes(r.member) for r in made)))
    assert len(parsed) == 6
    for r, (headers, block) in zip(made, parsed):
        assert headers["WARC-Record-ID"] == r.record_id and headers["WARC-Refers-To"] == r.refers_to
        assert block.decode() == r.block and headers["WARC-Block-Digest"] == r.block_digest == b32(block)
    assert warc.derivatives(read.limit(0)).count() == 0


def test_query_against_an_independent_parser(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op10_warc_derivatives(spark, SF).collect()
    assert len(rows) == 2 * len(pages)
    for r in rows:
        page = pages[r.page_id]
        assert r.source_payload_digest == b32(page.html.encode()) and r.target_uri == page.url
        plain = Plain()
        plain.feed(page.html)
        plain.close()
        if r.warc_type == "conversion":
            assert r.block.split() == "".join(plain.words).split()
        else:
            assert r.block.count("outlink: ") <= len(set(plain.links))


def test_extra_columns_do_not_clash(spark):
    pages = spark.createDataFrame([(1, "http://a/", "x", "clash")], "page_id long, url string, html string, block string")
    assert warc.derivatives(warc.responses_of_pages(pages, "d").withColumn("extra", F.lit(1))).columns[:2] == ["page_id", "extra"]


def chunked(data, size=50):
    parts = [data[i : i + size] for i in range(0, len(data), size)]
    return b"".join(b"%x;x=y\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\nTrailer: t\r\n\r\n"


def test_coded_bodies_of_files_are_undone_and_only_texts_are_converted(spark, tmp_path):
    page, markup = PAGE.encode(), "text/html; charset=utf-8"
    raw = zlib.compressobj(wbits=-15)
    long = page + "".join(f"<p>{hashlib.md5(b'%d' % i).hexdigest()}" for i in range(2000)).encode()
    bodies = {
        "gzip": (markup, "Content-Encoding: gzip", gzip.compress(page)),
        "members": (markup, "Content-Encoding: x-gzip", gzip.compress(page[:99]) + gzip.compress(page[99:])),
        "deflate": (markup, "content-encoding: Deflate", zlib.compress(page)),
        "raw": (markup, "Content-Encoding: deflate", raw.compress(page) + raw.flush()),
        "chunked": (markup, "Transfer-Encoding: chunked", chunked(page)),
        "both": (markup, "Content-Encoding: gzip\r\nTransfer-Encoding: chunked", chunked(gzip.compress(page))),
        "decoded": (markup, "Content-Encoding: gzip\r\nTransfer-Encoding: chunked", page),
        "undeflated": (markup, "Content-Encoding: deflate", page),
        "cut": (markup, "Content-Encoding: gzip", gzip.compress(long)[:-9000]),
        "brotli": (markup, "Content-Encoding: br", bytes(range(256))),
        "image": ("image/png", "X: y", b"\x89PNG\r\n" + bytes(range(256))),
        "untyped": ("", "X: y", b"\x89PNG\r\n" + bytes(range(256))),
        "plain": ("text/plain", "Content-Encoding: gzip", gzip.compress(b"a <b> c")),
    }
    (tmp_path / "a.warc.gz").write_bytes(b"".join(
        warc.serialise("response", f"<urn:{name}>", [("WARC-Target-URI", "http://a.example/d/")],
                       f"HTTP/1.1 200 OK\r\nContent-Type: {kind}\r\n{head}\r\n\r\n".encode() + body)
        for name, (kind, head, body) in bodies.items()
    ))
    read = warc.read_responses(spark.read.format("binaryFile").load(str(tmp_path)))
    got = {(r.refers_to[5:-1], r.warc_type): r for r in warc.derivatives(read).collect()}
    title, language, links, text = warc.read_page(PAGE, "http://a.example/d/")
    for name, (_, _, body) in bodies.items():
        meta = got.pop((name, "metadata"))
        assert meta.source_payload_digest == b32(body)
        if name in ("brotli", "image", "untyped", "plain"):
            assert "title: " not in meta.block and "outlink: " not in meta.block
            continue
        assert f"title: {title}" in meta.block.split("\r\n")
        assert [v[9:] for v in meta.block.split("\r\n") if v.startswith("outlink: ")] == links
        found = got.pop((name, "conversion")).block
        assert found == text or name == "cut" and found.startswith(text) and len(found) > 20000
    assert got.pop(("plain", "conversion")).block == "a <b> c" and not got


def test_chunks_that_are_cut_or_no_chunks():
    assert warc._unchunked(chunked(b"abc" * 99)) == b"abc" * 99 and warc._unchunked(b"0\r\n\r\n") == b""
    assert warc._unchunked(chunked(b"a" * 99)[:40]) == b"a" * 32
    for body in (b"", b"plain", b"add\nplain text that is longer than its first word" * 99, b"12\r\n"):
        assert warc._unchunked(body) == body


def record_of(name, block, length=None):
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <{name}>\r\nContent-Length: {len(block) if length is None else length}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def read_all(content, **options):
    out = [(reason, h.get("WARC-Record-ID", "").strip("<>"), b) for reason, h, b in warc.parse_records(content, **options)]
    return [(name, b) for reason, name, b in out if reason is None], [reason for reason, *_ in out if reason is not None]


def test_damaged_files_give_all_good_records_and_counted_rejects():
    blocks = [(str(i), (f"body {i} " * (i * 40 + 1)).encode()) for i in range(6)]
    members = [gzip.compress(record_of(n, b)) for n, b in blocks]
    whole = b"".join(record_of(n, b) for n, b in blocks)
    assert read_all(b"".join(members)) == (blocks, []) == read_all(whole) == read_all(gzip.compress(whole))
    assert read_all(b"".join(members) + b"\0" * 3000) == (blocks, [])
    assert read_all(b"".join(members) + b"trailing") == (blocks, ["bytes after the last member"])
    broken = bytearray(members[2])
    broken[len(broken) // 2] ^= 0xFF
    broken[len(broken) // 2 + 1] ^= 0xFF
    good, bad = read_all(b"".join(members[:2]) + bytes(broken) + b"".join(members[3:]))
    assert good == blocks[:2] + blocks[3:] and bad
    good, bad = read_all(b"".join(members)[:-20])
    assert good == blocks[:-1] and bad == ["cut member"]
    assert read_all(whole[:-20]) == (blocks[:-1], ["cut record"])
    odd = record_of("a", b"first") + record_of("x", b"odd", "many") + record_of("y", b"odd", "-3") + record_of("b", b"last")
    assert read_all(odd) == ([("a", b"first"), ("b", b"last")], ["bad length"] * 2)
    large = record_of("a", b"first") + record_of("x", b"z" * 300000) + record_of("b", b"last")
    for content in (large, gzip.compress(large)):
        assert read_all(content, max_block=1000) == ([("a", b"first"), ("b", b"last")], ["too large"])
    assert read_all(b"") == read_all(b"no archive") == read_all(b"\x1f\x8b") == ([], [])
    assert read_all(b"WARC/1.1\r\nWARC-Type: response") == ([], ["no end of headers"])
    assert read_all(record_of("x", b"", 10**17)) == ([], ["too large"])


def test_a_folder_of_good_and_damaged_files(spark, tmp_path):
    good = gzip.compress(record_of("good", b"HTTP/1.1 200 OK\r\n\r\nhello"))
    (tmp_path / "a.warc.gz").write_bytes(good * 3)
    (tmp_path / "b.warc.gz").write_bytes(good + b"\x1f\x8b\x08garbage" + good)
    (tmp_path / "c.warc").write_bytes(record_of("x", b"12", "none") + record_of("y", b"HTTP/1.1 200 OK\r\n\r\n"))
    (tmp_path / "d.warc.gz").write_bytes(good * 200)
    files = spark.read.format("binaryFile").load(str(tmp_path))
    archive = warc.read_archive(files, max_file=10_000)
    counts = {(r.path.rsplit("/", 1)[1], r.reason): r.n for r in warc.reject_counts(archive).collect()}
    assert counts == {("b.warc.gz", "damaged member"): 1, ("c.warc", "bad length"): 1, ("d.warc.gz", "file too large"): 1}
    assert archive.where("reason IS NULL").count() == 3 + 2 + 1
    assert warc.derivatives(warc.read_responses(files)).where("warc_type = 'metadata'").count() == 3 + 2 + 1 + 200


def test_a_coding_may_inflate_to_a_bound_only(monkeypatch):
    monkeypatch.setattr(warc, "MAX_BODY", 1000)
    monkeypatch.setattr(warc.content, "__defaults__", (1000,))
    bomb = gzip.compress(b"a" * 10_000_000)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/plain\r\nContent-Encoding: gzip\r\n\r\n" + bomb
    metadata, conversion = warc.derive_one("<x>", None, None, {}, block)
    assert "body-cut-at: 1000\r\n" in metadata[-1] and conversion[-1] == "a" * 1000
    small = b"HTTP/1.1 200 OK\r\nContent-Type: text/plain\r\nContent-Encoding: gzip\r\n\r\n" + gzip.compress(b"b" * 1000)
    metadata, conversion = warc.derive_one("<x>", None, None, {}, small)
    assert "body-cut-at" not in metadata[-1] and conversion[-1] == "b" * 1000
