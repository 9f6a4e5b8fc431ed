"""Derived WARC records: linked metadata and plain text of response records.

Each response gives a ``metadata`` record (JSON: HTTP headers, title, links, digests of
the source) and a ``conversion`` record (plain text). Both name the response in
WARC-Refers-To, keep its target URI and date, and repeat its payload digest in
WARC-Refers-To-Payload-Digest; the metadata names the conversion and the other way round
(WARC-Concurrent-To). Record ids are UUIDs of the response id, type and block digest, so
a repeated run gives the same records. Digests are SHA-1 in base 32.

Links are those of the page without comments and without the bodies of scripts and styles;
their opening tags, and what noscript and template hold, count. The source's HTTP headers
stand in ``fields`` as [name, value] in their order, repeated ones each; ``headers`` gives
them by name, a name that repeats with the list of its values.

The first ``<base href>`` of a page is the base of its links; ``srcset`` gives one link per
candidate. A very long page is read whole, in one pass.

Defined results: a null URL gives no target header, null HTML an empty payload and text;
ids may be null; repeated rows give repeated records; an empty table gives none; other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprism.llm.common import slices

DATE = "1970-01-01T00:00:00Z"
BLOCKS = frozenset("p div br hr li ul ol dl dt dd table tr h1 h2 h3 h4 h5 h6 section article header footer nav main aside blockquote pre form figure title".split())
RAW = ("script", "style")  # bodies are no markup
UNSEEN = {"head": "\n", "noscript": " ", "template": " "}  # bodies give links but no text
LINKING = frozenset(("a", "area", "img", "link", "script", "iframe", "source"))
NAME = re.compile(r"</?([a-zA-Z!?][^\s/<>]*)")
PLAIN = re.compile(r"[^<>\"']*")
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
CANDIDATE = re.compile(r"[\s,]*(\S*[^\s,])(?:\s+[^,]*)?(?:,|$)")
BLANKS = re.compile(r"[ \t\r\f\v\xa0]+")


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(parts))}>"


class Page:
    """Text, title and links of an HTML page, in one pass.

    A tag ends at the first ``>`` outside quoted values; one that meets another ``<`` first, or the
    end, is no tag. A comment or body whose end is missing is not skipped. Searches for an end go
    on from the place reached, and one that failed is not made again, so time is linear."""

    def __init__(self, page: str):
        self.page, self.title, self.base = page, None, None
        self.found: list[tuple[str, str, str]] = []  # element, attribute, value
        self._missing: set[str] = set()
        pieces, at, unseen = [], 0, 0  # text before ``unseen`` is not shown
        while True:
            i = page.find("<", at)
            if i < 0:
                break
            if i >= unseen:
                pieces.append(page[max(at, unseen):i])
            if page.startswith("<!--", i) and (end := self._after("-->", i + 4)):
                pieces.append(" ")
                at = end
                continue
            end = self._tag_end(i)
            if not end:
                if i >= unseen:
                    pieces.append("<")
                at = i + 1
                continue
            tag = page[i:end]
            name = NAME.match(tag)[1].lower()
            at = end
            if i >= unseen and name in BLOCKS:
                pieces.append("\n")
            if tag[1] == "/":
                continue
            if name in LINKING or name == "base":
                self._link(name, tag)
            if name == "title" and self.title is None and (close := self._after("</title", end)):
                self.title = page[end:close - len("</title")]
            if name in RAW and (close := self._after("</" + name, end)):
                pieces.append(" ")
                at = page.find(">", close) + 1 or len(page)
            elif name in UNSEEN and i >= unseen and (close := self._after("</" + name, end)):
                pieces.append(UNSEEN[name])
                unseen = page.find(">", close) + 1 or len(page)
        pieces.append(page[max(at, unseen):])
        self._text = "".join(pieces)

    def _after(self, mark: str, start: int) -> int:
        """Place after the next ``mark`` (any case), 0 if there is none."""
        if mark in self._missing:
            return 0
        m = _marks(mark).search(self.page, start)
        if not m:
            self._missing.add(mark)
        return m.end() if m else 0

    def _tag_end(self, i: int) -> int:
        page = self.page
        name = NAME.match(page, i)
        at = name.end() if name else 0
        while name:
            at = PLAIN.match(page, at).end()
            c = page[at:at + 1]
            if c == ">":
                return at + 1
            if c in ("", "<"):
                return 0
            value = page[max(0, at - 8):at].rstrip().endswith("=")
            at = (value and self._after(c, at + 1)) or at + 1
        return 0

    def _link(self, name: str, tag: str) -> None:
        own: dict[str, str] = {}
        for m in ATTRIBUTE.finditer(tag, len(name) + 1):
            own.setdefault(m[1].lower(), html.unescape(next((x for x in m.group(2, 3, 4) if x is not None), "")).strip())
        if name == "base":
            self.base = own.get("href") if self.base is None else self.base
            return
        first = next((k for k in own if k in ("href", "src")), None)
        if first:
            self.found.append((name, first, own[first]))
        if name in ("img", "source"):
            self.found += [(name, "srcset", m[1]) for m in CANDIDATE.finditer(own.get("srcset", ""))]

    def text(self) -> str:
        """One line per block, blanks collapsed, entities resolved."""
        lines = (BLANKS.sub(" ", x).strip() for x in html.unescape(self._text).split("\n"))
        return "\n".join(x for x in lines if x)

    def links(self, base: str) -> list[dict[str, str]]:
        """Links in order of appearance, made absolute (by the page's own base) where the URL allows."""
        base = _joined(base, self.base) if self.base else base
        return [{"path": f"{name.upper()}@/{attribute}", "url": _joined(base, to)} for name, attribute, to in self.found]


@lru_cache(maxsize=64)
def _marks(mark: str) -> re.Pattern:
    return re.compile(re.escape(mark), re.I)


def _joined(base: str, to: str) -> str:
    try:
        return urljoin(base, to)
    except ValueError:
        return to


def plain_text(page: str) -> str:
    return Page(page).text()


def links(page: str, base: str) -> list[dict[str, str]]:
    return Page(page).links(base)


def http_fields(lines: list[str]) -> list[list[str | None]]:
    """[name, value] of each header line; a folded line goes on with the value before it,
    a line without a colon has no value."""
    out: list[list[str | None]] = []
    for line in lines:
        if out and line[:1] in (" ", "\t"):
            out[-1][1] = f"{out[-1][1] or ''} {line.strip()}".strip()
        elif line.strip():
            name, colon, value = line.partition(":")
            out.append([name.strip(), value.strip() if colon else None])
    return out


def by_name(fields: list[list[str | None]]) -> dict[str, str | None | list[str | None]]:
    """Values by name; all of them in order where a name repeats."""
    out: dict[str, list[str | None]] = {}
    for name, value in fields:
        out.setdefault(name, []).append(value)
    return {name: own if len(own) > 1 else own[0] for name, own in out.items()}


def header(fields: list[tuple[str, str | None]]) -> str:
    return "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n"


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = DATE) -> DataFrame:
    """Response records of crawled pages: id, record_id, target_uri, date, http (header
    text), payload."""
    known = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in (id_col, url_col)]

    @F.arrow_udf("string")
    def ids(keys: pa.Array, urls: pa.Array) -> pa.Array:
        return pa.array([record_id("response", k.as_py(), u.as_py()) for k, u in zip(keys, urls)])

    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"))
    return pages.select(F.col(id_col).alias("id"), ids(*known).alias("record_id"), F.col(url_col).alias("target_uri"),
                        F.lit(date).alias("date"), http.alias("http"), payload.alias("payload"))


def derive(records: DataFrame) -> DataFrame:
    """Two rows per response: id, warc_type, record_id, refers_to, target_uri, date,
    content_type, block_digest, payload_digest (of the source), n_links, ``header`` and
    ``content``; header, content and two line ends are the record as it stands in a file."""
    names = ["id", "warc_type", "record_id", "refers_to", "target_uri", "date", "content_type", "block_digest", "payload_digest", "n_links", "header", "content"]

    def both(key, source: str, uri: str | None, date: str, http: str, payload: bytes) -> Iterator[tuple]:
        page, found = payload.decode("utf-8", "replace"), digest(payload)
        read = Page(page)
        own, text = read.links(uri or ""), read.text().encode()
        status, *lines = http.rstrip("\r\n").split("\r\n")
        fields = http_fields(lines)
        envelope = {"source": {"record_id": source, "target_uri": uri, "date": date, "payload_digest": found, "payload_length": len(payload)},
                    "http": {"status": status, "headers": by_name(fields), "fields": fields},
                    "html": {"title": html.unescape(read.title).strip() if read.title is not None else None, "links": own},
                    "text": {"digest": digest(text), "length": len(text)}}
        meta = json.dumps(envelope, ensure_ascii=False, sort_keys=True).encode()
        ids = {kind: record_id(kind, source, digest(block)) for kind, block in (("metadata", meta), ("conversion", text))}
        for kind, block, other, mime in (("metadata", meta, "conversion", "application/json"), ("conversion", text, "metadata", "text/plain")):
            head = header([("WARC-Type", kind), ("WARC-Record-ID", ids[kind]), ("WARC-Refers-To", source), ("WARC-Concurrent-To", ids[other]),
                           ("WARC-Target-URI", uri and uri.replace("\r", "%0D").replace("\n", "%0A")), ("WARC-Date", date), ("WARC-Refers-To-Payload-Digest", found),
                           ("WARC-Block-Digest", digest(block)), ("WARC-Payload-Digest", digest(block)), ("Content-Type", mime), ("Content-Length", str(len(block)))])
            yield key, kind, ids[kind], source, uri, date, mime, digest(block), found, len(own), head, block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 5):
            rows = [r for row in zip(*(c.to_pylist() for c in b.columns)) for r in both(*row)]
            cols = list(zip(*rows))
            kinds = [b.schema.field(0).type, *[pa.string()] * 8, pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    kind = records.schema["id"].dataType.simpleString()
    schema = ", ".join([f"id {kind}", *(f"{n} string" for n in names[1:9]), "n_links long, header string, content binary"])
    return records.select("id", "record_id", "target_uri", "date", "http", "payload").mapInArrow(run, schema)
