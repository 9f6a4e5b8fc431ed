import base64
import hashlib
import json
import time
from html.parser import HTMLParser

from tabprism.llm import queries, warc_derive
from tests.llm.helpers import SF


def parse(raw):
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *fields = head.decode().split("\r\n")
    assert version == "WARC/1.1"
    fields = dict(f.split(": ", 1) for f in fields)
    block = rest[:int(fields["Content-Length"])]
    assert rest[len(block):] == b"\r\n\r\n"
    return fields, block


def sha(block):
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def test_text_and_links():
    page = ('<html><head><title>A &amp; B</title><style>p{x}</style></head><body><!-- no <p>this</p> --><script>var t="</p>";</script>'
            "<p>One&nbsp; two<br>three <b>bo</b>ld</p><a href='/x?a=1&amp;b=2'>link</a> 1 < 2 <img alt=q src=pic.png></body>")
    assert warc_derive.plain_text(page) == "One two\nthree bold\nlink 1 < 2"
    assert warc_derive.links(page, "http://h.example/d/e") == [{"path": "A@/href", "url": "http://h.example/x?a=1&b=2"}, {"path": "IMG@/src", "url": "http://h.example/d/pic.png"}]
    assert warc_derive.plain_text("") == warc_derive.plain_text("<p></p>") == ""


def check(pages, got):
    html = {r.page_id: r.html for r in pages}
    by = {}
    for r in got:
        fields, block = parse(r.header.encode() + r.content.encode() + b"\r\n\r\n")
        payload = (html[r.page_id] or "").encode()
        assert fields["WARC-Type"] == r.warc_type and fields["WARC-Refers-To"] == r.refers_to and fields["WARC-Record-ID"] == r.record_id
        assert fields["WARC-Block-Digest"] == r.block_digest == sha(block)
        assert fields["WARC-Refers-To-Payload-Digest"] == r.payload_digest == sha(payload)
        assert fields.get("WARC-Target-URI") == r.target_uri and fields["WARC-Date"] == r.date
        by.setdefault(r.page_id, {})[r.warc_type] = (fields, block, r)
    for own in by.values():
        (meta, envelope, m), (text, block, _) = own["metadata"], own["conversion"]
        assert meta["WARC-Concurrent-To"] == text["WARC-Record-ID"] and text["WARC-Concurrent-To"] == meta["WARC-Record-ID"]
        data = json.loads(envelope)
        assert data["source"]["record_id"] == m.refers_to and data["text"] == {"digest": sha(block), "length": len(block)}
        assert data["http"]["headers"]["Content-Type"].startswith("text/html") and len(data["html"]["links"]) == m.n_links


def test_query_round_trip(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = queries.op5_warc_derive(spark, SF).collect()
    assert len(got) == 2 * len(pages) and len({r.record_id for r in got}) == len(got)
    check(pages, got)
    again = {r.record_id for r in queries.op5_warc_derive(spark, SF).collect()}
    assert again == {r.record_id for r in got}


def test_edge_rows(spark):
    rows = [(1, None, None, "x"), (2, "", "", "x"), (None, "http://[bad", "<a href='q'>", "x"), (4, "http://a.example/", "<p>" + "w " * 200_000, "x"), (5, "u\r\nWARC-Type: x", "t", "x"), (7, "u", "<p>é", "x"), (7, "u", "<p>é", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, header string")
    got = warc_derive.derive(warc_derive.responses(pages)).collect()
    assert len(got) == 14
    for r in got:
        parse(r.header.encode() + bytes(r.content) + b"\r\n\r\n")
    assert len({(r.record_id) for r in got}) == 12
    assert warc_derive.derive(warc_derive.responses(pages.limit(0))).count() == 0


def test_external_scripts_and_noscript_are_links():
    page = ("<head><script src='/a.js' defer></script><SCRIPT type=module SRC=b.js>var x = '<img src=no.png>';</SCRIPT ><style>a{} <a href=no></style></head>"
            "<!-- <script src=no.js></script> --><noscript><img src='n.png'><iframe src=f.html></iframe></noscript><template><a href=t>t</a></template><script>'<a href=no>'</script>")
    assert [(x["path"], x["url"]) for x in warc_derive.links(page, "http://h.example/d/")] == [
        ("SCRIPT@/src", "http://h.example/a.js"), ("SCRIPT@/src", "http://h.example/d/b.js"), ("IMG@/src", "http://h.example/d/n.png"),
        ("IFRAME@/src", "http://h.example/d/f.html"), ("A@/href", "http://h.example/d/t")]
    assert warc_derive.plain_text(page) == ""


def test_source_headers_are_all_kept_in_order(spark):
    http = "HTTP/1.1 200 OK\r\nSet-Cookie: a=1; Path=/\r\nName:value\r\nVary: Accept\r\nSet-Cookie: b=2\r\nLong: one\r\n two\r\nEmpty:\r\nodd\r\n\r\n"
    records = spark.createDataFrame([(1, "<urn:uuid:1>", "http://h.example/", warc_derive.DATE, http, bytearray(b"<script src=x.js></script>"))],
                                    "id long, record_id string, target_uri string, date string, http string, payload binary")
    r = next(r for r in warc_derive.derive(records).collect() if r.warc_type == "metadata")
    data = json.loads(bytes(r.content))
    assert data["http"]["fields"] == [["Set-Cookie", "a=1; Path=/"], ["Name", "value"], ["Vary", "Accept"], ["Set-Cookie", "b=2"], ["Long", "one two"], ["Empty", ""], ["odd", None]]
    assert data["http"]["headers"]["Set-Cookie"] == ["a=1; Path=/", "b=2"] and data["http"]["headers"]["Name"] == "value"
    assert r.n_links == 1 and data["html"]["links"] == [{"path": "SCRIPT@/src", "url": "http://h.example/x.js"}]
    assert r.block_digest == sha(bytes(r.content))


class Parsed(HTMLParser):
    """Text lines and links by the standard library's parser."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.hidden, self.out, self.found = 0, [], []
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag in ("head", "noscript", "template", "script", "style"):
            self.hidden += 1
        if tag in warc_derive.BLOCKS or tag in ("head",):
            self.out.append("\n")
        own = dict(reversed(attrs))
        if tag in warc_derive.LINKING:
            self.found += [(tag.upper() + "@/" + k, (own[k] or "").strip()) for k in dict(attrs) if k in ("href", "src")][:1]

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.hidden -= tag in ("head", "noscript", "template", "script", "style")

    def handle_endtag(self, tag):
        if tag in ("head", "noscript", "template", "script", "style"):
            self.hidden -= 1
            self.out.append(" ")
        if tag in warc_derive.BLOCKS:
            self.out.append("\n")

    def handle_comment(self, data):
        self.out.append(" ")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)

    def text(self):
        lines = (" ".join(x.replace("\xa0", " ").split(" ")) for x in "".join(self.out).split("\n"))
        return "\n".join(y for y in (" ".join(x.split()) for x in lines) if y)


def test_all_pages_against_the_standard_parser():
    import pyarrow.parquet as pq
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist()
    assert len(pages) > 100
    for r in pages:
        other, own = Parsed(r["html"] or ""), warc_derive.Page(r["html"] or "")
        assert " ".join(own.text().split()) == " ".join(other.text().split()), r["page_id"]
        assert own.text().count("\n") == other.text().count("\n")
        assert [(x["path"], x["url"]) for x in own.links("")] == [(p, u) for p, u in other.found]


def test_base_srcset_and_quoted_marks():
    page = ('<base href="/sub/"><a title="a > b" href=x>one</a><img srcset="s.png 1x, /l.png 2x" src="p.png"><a href=\'q"r\'>two</a>'
            '<noscript><img src=n.png>no</noscript><SCRIPT SRC=s.js>if (a < b) "</p>";</SCRIPT> 3 < 4 <b')
    own = warc_derive.Page(page)
    assert own.text() == "onetwo 3 < 4 <b"
    assert [x["url"] for x in own.links("http://h.example/d/e")] == ["http://h.example/sub/x", "http://h.example/sub/p.png", "http://h.example/sub/s.png", "http://h.example/l.png",
                                                                     'http://h.example/sub/q"r', "http://h.example/sub/n.png", "http://h.example/sub/s.js"]
    assert warc_derive.Page("<title>A &lt; B</title>x").title == "A &lt; B"


def test_a_megabyte_of_unclosed_marks_is_read_in_linear_time():
    for mark in ("<script ", "<a ", "<!--", "<a href='", '<a href="', "<script>", "<noscript>", "<head><a x='", "<", "</", "<a \"'", "<title>", "<p =\"<b ='"):
        began = time.process_time()
        warc_derive.Page(mark * (1_000_000 // len(mark))).text()
        assert time.process_time() - began < 4, mark
