"""Op 9: metadata and plain-text conversion records derived from HTTP responses.

Every response gives a metadata record (application/warc-fields: title, language, character set, links and the
headers of the source) and a conversion record (its visible text). Both refer to the response by its record
id, keep its target and date, and carry the payload digest of the source beside their own block digest.

Record ids are derived from the source's id, which hashes page id, address and content, so a retried task writes the same
records and only equal pages share an id. Null url or html count
as empty; an empty page gives an empty conversion. Repeated pages give repeated records. Extra columns are ignored.

Comments and hidden elements are found in one go from left to right, so a comment's start inside a script is text
of the script. A head is not hidden as a whole, as its end tag may be left out; what may stand in it is hidden or empty.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, pieces, table, whole_text
from .registry import query

#: Pages of the given table have no capture time.
UNKNOWN_DATE = "1970-01-01T00:00:00Z"
# fixed values: elements whose content is not text, and elements that start a new line
HIDDEN = ("script", "style", "noscript", "noframes", "template", "title", "svg", "iframe", "textarea")
BLOCKS = ("address", "article", "aside", "blockquote", "body", "br", "caption", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
          "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "nav", "ol", "option", "p", "pre", "section", "table", "td", "th", "tr", "ul")

_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)")
_STOP = re.compile("[\"'>]")
_HIDDEN_END = {x: re.compile(rf"</{x}\s*>", re.I) for x in HIDDEN}
#: What ends a title that has no end tag of its own.
_TITLE_STOP = re.compile(r"</?(?:head|body|title)\b", re.I)
_SPACES, _LINES = re.compile(r"[^\S\n]+"), re.compile(r" ?\n[\s]*")
_LANG = re.compile(r"""\blang\s*=\s*["']?([\w-]+)""", re.I)
_CHARSET = re.compile(r"""\bcharset\s*=\s*["']?([\w-]+)""", re.I)
_HREF = re.compile(r"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


class Scanner:
    """Reads a page once, from left to right, in time linear in its size.

    A tag ends at the first ``>`` outside of quotes; without one its ``<`` is text. Where a scan for that end has been, it
    leaves what it found, so that no later tag's scan goes the same way again: each quote is opened once at most.
    """

    def __init__(self, page: str, nested: bool = False):
        self.page, self.nested = page, nested
        self.last = {c: page.rfind(c) for c in "\"'>"}
        self.ends: dict[int, int] = {}   # position of a quote or '>' met outside of quotes -> end of the tag, or -1
        self.ahead = (0, -1)             # (from, first quote or '>' from there on)
        self.text: list[str] = []
        self.links: list[str] = []
        self.title = self.lang = self.charset = ""
        self._read()

    def _stop(self, at: int) -> int:
        """The first quote or ``>`` from ``at`` on, or -1."""
        since, found = self.ahead
        if not since <= at <= found:
            m = _STOP.search(self.page, at)
            found = m.start() if m else len(self.page)
            self.ahead = (at, found)
        return found if found < len(self.page) else -1

    def _tag_end(self, at: int) -> int:
        """Place after the tag whose inside starts at ``at``, or -1."""
        if at > self.last[">"]:
            return -1
        way, where, end = [], self._stop(at), -1
        while where >= 0:
            if where in self.ends:
                end = self.ends[where]
                break
            way.append(where)
            c = self.page[where]
            if c == ">":
                end = where + 1
                break
            if where >= self.last[c]:
                break
            m = _STOP.search(self.page, self.page.index(c, where + 1) + 1)
            where = m.start() if m else -1
        for k in way:
            self.ends[k] = end
        return end

    def _until(self, mark: str, at: int) -> int:
        found = self.page.find(mark, at)
        return len(self.page) if found < 0 else found + len(mark)

    def _read(self) -> None:
        page, at = self.page, 0
        while True:
            start = page.find("<", at)
            if start < 0:
                self.text.append(page[at:])
                return
            self.text.append(page[at:start])
            at = start
            if page.startswith("<!--", at):
                at = self._until("-->", at + 4)
            elif page.startswith("<![CDATA[", at):
                at = self._until("]]>", at + 9)
            elif page.startswith(("<!", "<?"), at):
                end = page.find(">", at) if at < self.last[">"] else -1
                self.text.append("<" if end < 0 else "")
                at = at + 1 if end < 0 else end + 1
            else:
                m = _NAME.match(page, at)
                end = self._tag_end(m.end()) if m else -1
                if end < 0:
                    self.text.append("<")
                    at += 1
                else:
                    at = self._element(m, at, end)

    def plain(self) -> str:
        text = _SPACES.sub(" ", html.unescape("".join(self.text)).replace("\r", "\n"))
        return _LINES.sub("\n", text).strip()

    def _element(self, m: re.Match, at: int, end: int) -> int:
        """Takes what a tag says; the place to go on at, after the content of a hidden element."""
        name, opens = m[2].lower(), not m[1]
        if name == "a" and opens:
            found = _HREF.search(self.page[at:end])
            if found:
                self.links.append(html.unescape("".join(x or "" for x in found.groups())))
        if self.nested:
            return end
        if opens and name in HIDDEN:
            self.text.append(" ")
            if name == "title":
                stop = _TITLE_STOP.search(self.page, end)
                close = _HIDDEN_END["title"].match(self.page, stop.start()) if stop else None
                if close:
                    self.title = self.title or self.page[end:close.start()]
                    return close.end()
                after = self.page.find("<", end)
                return len(self.page) if after < 0 else after
            close = _HIDDEN_END[name].search(self.page, end)
            self.links += Scanner(self.page[end:close.start() if close else len(self.page)], nested=True).links
            return close.end() if close else len(self.page)
        if opens and name in ("html", "meta"):
            pattern, field = (_LANG, "lang") if name == "html" else (_CHARSET, "charset")
            found = pattern.search(self.page[at:end])
            if found and not getattr(self, field):
                setattr(self, field, found[1])
        self.text.append("\n" if name in _BLOCK_NAMES else "")
        return end


_BLOCK_NAMES = frozenset(BLOCKS)


def plain_text(page: str) -> str:
    """Visible text: a line for each block, single spaces, character references resolved."""
    return Scanner(page).plain()


def _links(page: str) -> list[str]:
    return Scanner(page).links


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(kind: str, source: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind}:{source}')}>"


def serialise(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in headers)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def responses(pages: DataFrame, date: str = UNKNOWN_DATE) -> DataFrame:
    """Response records of crawled pages: page_id, record_id, target_uri, warc_date, headers and html."""
    # pages may share an id and an address, or have none: the content tells them apart
    page = [F.col("page_id").cast("string"), F.col("url").cast("string"), F.sha1(whole_text("html"))]
    source = F.concat_ws("|", *(F.coalesce(c, F.lit("")) for c in page))
    hexed = F.md5(F.concat(F.lit("response|"), source))
    spans = [F.substring(hexed, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    length = F.octet_length(whole_text("html")).cast("string")
    headers = F.concat(F.lit("Content-Type: text/html; charset=utf-8\r\nContent-Length: "), length)
    return pages.select(F.col("page_id").cast("bigint"), F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *spans), F.lit(">")).alias("record_id"),
                        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("target_uri"), F.lit(date).alias("warc_date"), headers.alias("headers"),
                        whole_text("html").alias("html"))


def _derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "kind", "record_id", "refers_to", "target_uri", "content_type", "block_digest", "source_digest", "content_length", "record"]
    kinds = [pa.int64(), *[pa.string()] * 7, pa.int64(), pa.binary()]
    for batch in pieces(batches, "html"):
        rows = []
        for r in batch.to_pylist():
            page, source = r["html"], r["record_id"]
            payload = digest(page.encode())
            read = Scanner(page)
            fields = [("title", html.unescape(read.title)), ("declared-language", read.lang), ("charset", read.charset),
                      *(("source-header", h) for h in r["headers"].split("\r\n") if h), *(("outlink", x) for x in read.links)]
            meta = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in fields if v).encode()
            for kind, content_type, block in (("metadata", "application/warc-fields", meta), ("conversion", "text/plain; charset=utf-8", read.plain().encode())):
                own = record_id(kind, source)
                head = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Refers-To", source), ("WARC-Target-URI", r["target_uri"]), ("WARC-Date", r["warc_date"]),
                        ("WARC-Refers-To-Target-URI", r["target_uri"]), ("WARC-Refers-To-Date", r["warc_date"]), ("WARC-Source-Payload-Digest", payload),
                        ("WARC-Block-Digest", digest(block)), ("Content-Type", content_type)]
                rows.append((r["page_id"], kind, own, source, r["target_uri"], content_type, digest(block), payload, len(block), serialise(head, block)))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)


def derivatives(sources: DataFrame) -> DataFrame:
    """A metadata and a conversion record for every response record, with the serialised bytes in ``record``."""
    return arrow_map(sources, _derive, "page_id bigint, kind string, record_id string, refers_to string, target_uri string, content_type string, "
                                       "block_digest string, source_digest string, content_length bigint, record binary")


def write(records: DataFrame, folder: str, limit: int = 1 << 30) -> DataFrame:
    """Write the records as gzip members to files of about ``limit`` bytes in a folder all executors reach.

    Returns the files (file, records). Each has a name of its own, so those of a lost task are not in the list.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = (fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")) if folder.startswith("file:") else fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        out, name, count, size, done = None, "", 0, 0, []
        for batch in batches:
            for record in batch.column("record"):
                if out is None:
                    name, count, size = f"{path}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(name, compression=None)
                member = gzip.compress(record.as_py(), mtime=0)
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= limit:
                    out.close()
                    out = None
                    done.append((name, count))
        if out is not None:
            out.close()
            done.append((name, count))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["file", "records"])
    return arrow_map(records.select("record"), run, "file string, records bigint")


@query("op9_warc_derivatives")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = derivatives(responses(table(spark, sf_dir, "pages")))
    return made.withColumn("record_sha256", F.sha2("record", 256)).drop("record")
