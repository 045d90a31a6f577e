"""WARC derivative builder: linked metadata and plain-text conversion records of responses.

Each response yields a ``metadata`` record (application/warc-fields with the source's HTTP
headers, digests and sizes) and a ``conversion`` record (the page as plain text).  Both carry
``WARC-Refers-To`` with the response's record id, its target URI and date, and digests of
their own block; the source's digests are kept.  Record ids are derived from the source's id,
so a recomputed task writes the same records.  One pass, no shuffle.

Edge cases: a null payload counts as empty and gives an empty conversion; null uri, date or
headers are left out of the records; a response without record id gets one derived from its
uri and payload; repeated responses give repeated records; an empty table gives none; other
columns are not read.  A page's text takes time linear in its length, unclosed markup included
(see ``plain_text``).
"""
from __future__ import annotations

import base64
import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, map_batches, unescape

#: Elements left out with their content up to their own end tag, and tags that end a line.
HIDDEN = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ("script", "style", "noscript", "template")}
BREAKS = frozenset("br hr p div li ul ol tr table h1 h2 h3 h4 h5 h6 section article header footer nav body blockquote "
                   "pre td th dd dt dl form main aside title".split())
#: A head without end tag ends at the body.
HEAD_END = re.compile(r"</head\s*>|(?=<body[\s/>])", re.I)
NAME = re.compile(r"/?([a-zA-Z]\w*)")
BLANKS, LINES = re.compile(r"[^\S\n]+"), re.compile(r" ?\n[\n ]*")
TITLE, TITLE_END = re.compile(r"<title\b", re.I), re.compile(r"</title\s*>", re.I)
HTML_TAG, LANGUAGE = re.compile(r"<html\b", re.I), re.compile(r"\blang\s*=\s*[\"']?([\w-]+)", re.I)
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL namespace of RFC 4122
RESPONSE = ["record_id", "target_uri", "date", "http_headers", "payload"]


def plain_text(markup: str) -> str:
    """Visible text: hidden elements dropped, block tags as line ends, references decoded.

    One scan forward, linear in the page whatever the markup.  A comment, a hidden element or a tag
    that never ends hides the rest of the page; a head that never ends is ended by the body, and
    without one only its tag goes."""
    out: list[str] = []
    at, end, head_ends = 0, len(markup), True
    while at < end:
        lt = markup.find("<", at)
        if lt < 0 or lt + 1 == end:
            out.append(markup[at:])
            break
        out.append(markup[at:lt])
        if markup.startswith("<!--", lt):
            stop = markup.find("-->", lt + 4)
            out.append(" ")
            at = stop + 3 if stop >= 0 else end
            continue
        name = NAME.match(markup, lt + 1)
        if not name and markup[lt + 1] not in "/!?":
            out.append("<")
            at = lt + 1
            continue
        tag = name[1].lower() if name else ""
        shut = None
        if tag in HIDDEN and markup[lt + 1] != "/":
            out.append(" ")
            shut = HIDDEN[tag].search(markup, name.end())
            at = shut.end() if shut else end
            continue
        if tag == "head" and markup[lt + 1] != "/" and head_ends:
            shut = HEAD_END.search(markup, name.end())
            head_ends = shut is not None  # no later head can find an end either
            if shut:
                out.append(" ")
                at = shut.end()
                continue
        stop = markup.find(">", lt)
        if stop < 0:
            break
        if tag in BREAKS:
            out.append("\n")
        at = stop + 1
    return LINES.sub("\n", BLANKS.sub(" ", unescape("".join(out)))).strip()


def page_title(markup: str) -> str | None:
    """Content of the first title; none if it never ends."""
    tag = TITLE.search(markup)
    start = markup.find(">", tag.end()) + 1 if tag else 0
    shut = TITLE_END.search(markup, start) if start else None
    return unescape(markup[start:shut.start()]) if shut else None


def page_language(markup: str) -> str | None:
    """The last language named in the first html tag."""
    tag = HTML_TAG.search(markup)
    if not tag:
        return None
    stop = markup.find(">", tag.end())
    named = LANGUAGE.findall(markup, tag.end(), stop if stop >= 0 else len(markup))
    return named[-1] if named else None


def sha1(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def urn(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(0).join(parts))}>"


def fields(pairs: list[tuple[str, str | None]]) -> str:
    """Named fields; line ends inside a value become blanks."""
    return "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in pairs if v is not None)


def warc_header(pairs: list[tuple[str, str | None]], block: bytes) -> str:
    return "WARC/1.1\r\n" + fields([*pairs, ("WARC-Block-Digest", sha1(block)), ("Content-Length", str(len(block)))])


def responses_from_pages(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of crawled pages (``page_id``, ``url``, ``html``)."""
    name = F.concat_ws(" ", F.lit("page"), F.col("page_id").cast("string"), F.col("url"))
    digest = F.md5(name.cast("binary"))
    parts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    size = F.octet_length(F.coalesce("html", F.lit(""))).cast("string")
    return pages.select("page_id", F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")).alias("record_id"),
                        F.col("url").alias("target_uri"), F.lit(date).alias("date"),
                        F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                                 size, F.lit("\r\n\r\n")).alias("http_headers"), F.col("html").alias("payload"))


def derivatives(responses: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Two rows per response: ``keep`` columns, ``record_type``, ``record_id``, ``refers_to``,
    ``target_uri``, ``header`` (WARC header lines), ``block`` and the digests."""
    out = [*[f"{c} {responses.schema[c].dataType.simpleString()}" for c in keep],
           "record_type string, record_id string, refers_to string, target_uri string, header string, block string, "
           "block_digest string, source_block_digest string, source_payload_digest string, n_bytes long"]

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_keep, columns = len(keep), [c.to_pylist() for c in batch.columns[len(keep):-1]]
        owner, rows = [], []
        for at, (payload, ids, uri, date, headers) in enumerate(zip(as_bytes(batch.column(batch.num_columns - 1)), *columns)):
            for row in _records(payload, ids, uri, date, headers):
                owner.append(at)
                rows.append(row)
        made = [pa.array(c, pa.string()) for c in list(zip(*rows))[:-1]] + [pa.array([r[-1] for r in rows], pa.int64())]
        kept = [batch.column(i).take(pa.array(owner)) for i in range(n_keep)]
        return pa.RecordBatch.from_arrays([*kept, *made], [*keep, "record_type", "record_id", "refers_to", "target_uri",
                                                           "header", "block", "block_digest", "source_block_digest",
                                                           "source_payload_digest", "n_bytes"])

    return map_batches(responses.select(*keep, *RESPONSE), convert, ", ".join(out))


def _records(payload: bytes, source: str | None, uri: str | None, date: str | None, headers: str | None):
    payload_digest, block_digest = sha1(payload), sha1((headers or "").encode() + payload)
    source = source or urn("response", uri or "", block_digest)
    markup = payload.decode("utf-8", "replace")
    title, language = page_title(markup), page_language(markup)
    text = plain_text(markup)
    conversion_id = urn(source, "conversion")
    description = fields([("source-headers", line) for line in (headers or "").split("\r\n") if line] +
                         [("source-block-digest", block_digest), ("source-payload-digest", payload_digest),
                          ("source-payload-length", str(len(payload))), ("conversion-record", conversion_id),
                          ("title", title), ("language", language), ("text-length", str(len(text)))])
    linked = [("WARC-Target-URI", uri), ("WARC-Date", date), ("WARC-Refers-To", source),
              ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", date), ("WARC-Payload-Digest", None)]
    for kind, record, mime, block in (("metadata", urn(source, "metadata"), "application/warc-fields", description),
                                      ("conversion", conversion_id, "text/plain; charset=utf-8", text)):
        data = block.encode("utf-8", "surrogatepass")
        header = warc_header([("WARC-Type", kind), ("WARC-Record-ID", record), *linked,
                              ("X-Source-Payload-Digest", payload_digest), ("Content-Type", mime)], data)
        yield kind, record, source, uri, header, block, sha1(data), block_digest, payload_digest, len(data)


def record_text(header: Column, block: Column) -> Column:
    """A whole record without its closing line ends (see ``write_warc``)."""
    return F.concat(header, F.lit("\r\n"), block)


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records as WARC files; the line separator closes each record."""
    records.select(record_text(F.col("header"), F.col("block")).alias("value")).write.option(
        "lineSep", "\r\n\r\n").option("compression", compression).text(path)
