"""WARC derivative builder: responses to linked metadata and plain-text conversion records.

For every response record two records are built that refer to it: ``metadata``
(application/warc-fields: status, every source header, title, language, links,
the source's digests and the conversion's id) and ``conversion`` (text/plain, the
readable text). Both keep the source's target URI and date and carry digests of
their own block; ids are derived from the source's id, so a rerun gives the same
records. Records are text and are written by Spark's text sink as WARC files.

Defined results: a NULL block is an empty response (no status, no headers, empty
text); a block without an HTTP head is taken as a body; bodies that are not text
get no conversion record; an unclosed script, style or title runs to the end of
the page, an unclosed head to the first thing that no head holds, and of other
unclosed elements only the tag goes, as of self-closed svg and iframe; bytes that do not decode become U+FFFD; a NULL URI
leaves its header out; repeated responses give repeated records.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import rebatched, text_batches, tidied, utf8

NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc-derivatives")
CRLF = "\r\n"

# Elements that hold no readable text, and elements that end a line.
SILENT = "script|style|noscript|template|iframe|svg|title|head"
LINES = ("address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|li|"
         "main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul")
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
TO_THE_END = ("script", "style", "title")
IN_HEAD = {"base", "basefont", "bgsound", "head", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}
_SILENT = re.compile(rf"<({SILENT})(?=[\s/>])[^>]*>", re.I)
_CLOSE = {t: re.compile(rf"</{t}\s*>", re.I) for t in SILENT.split("|")}
_EMPTY = re.compile(r"<(?:svg|iframe)(?:\s[^>]*[\s\"'])?/>", re.I)
_ANY = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)[^>]*>")
_LINE = re.compile(rf"</?(?:{LINES})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>", re.I)
_TAG = re.compile(r"</?[a-zA-Z!?](?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
_LOOSE = re.compile(r"</?[a-zA-Z!?][^>]*>")
_BLANK = re.compile(r"[^\S\n]+")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z0-9-]+)", re.I)
_LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)


def _after(page: str, name: str, at: int, missing: dict[str, int]) -> int:
    """End of the element whose content begins at ``at``; ``missing``: from where on a closing tag is known to be missing."""
    close = _CLOSE[name].search(page, at) if at < missing.get(name, len(page) + 1) else None
    if close:
        return close.end()
    missing[name] = min(at, missing.get(name, at))
    return len(page) if name in TO_THE_END else at


def _head_end(page: str, at: int, missing: dict[str, int]) -> int:
    """End of the head whose content begins at ``at``: after its closing tag, or before the first thing that no head holds."""
    begin, text, end = at, None, len(page)  # text behind an element of the head is such a thing if no </head> follows it
    while tag := _ANY.search(page, at):
        if text is None and at > begin and page[at:tag.start()].strip():
            text = at
        name = tag[2].lower()
        if tag[1] and name == "head":
            return tag.end()
        if name not in IN_HEAD:
            end = tag.start()
            break
        at = tag.end() if tag[1] or name not in _CLOSE or name == "head" else _after(page, name, tag.end(), missing)
    else:
        if text is None and at > begin and page[at:].strip():
            text = at
    return end if text is None else text


def _without_silent(page: str) -> str:
    out, at, missing, head = [], 0, {}, False
    while tag := _SILENT.search(page, at):
        out += page[at:tag.start()], " "
        name, at = tag[1].lower(), tag.end()
        if name != "head":
            at = at if _EMPTY.fullmatch(tag[0]) else _after(page, name, at, missing)
        elif not head:  # a page has one head, later tags of that name say nothing
            at, head = _head_end(page, at, missing), True
    return "".join([*out, page[at:]])


def plain_text(page: str) -> str:
    """Readable text of an HTML page, one line per block element."""
    page = _without_silent(_COMMENT.sub("", page))
    page = _LOOSE.sub("", _TAG.sub("", _LINE.sub("\n", page)))
    if "&" in page:
        page = html.unescape(page)
    return "\n".join(filter(None, map(str.strip, _BLANK.sub(" ", page).split("\n"))))


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _one_line(text: str) -> str:
    return " ".join(html.unescape(text).split())


def split_response(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """(status line, headers in order, body) of an HTTP response."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    head, _, body = block.partition(b"\r\n\r\n")
    status, *lines = head.decode("utf-8", "replace").split(CRLF)
    pairs = (line.partition(":") for line in lines)
    return status, [(name.strip(), value.strip()) for name, _, value in pairs if name.strip()], body


def derive(record_id: str, block: bytes) -> Iterator[tuple]:
    """(type, id, content type, source payload digest, block) of the records that follow from a response."""
    status, headers, body = split_response(block)
    kind = next((v for n, v in headers if n.lower() == "content-type"), "text/html")
    media = kind.partition(";")[0].strip().lower()
    charset = _CHARSET.search(kind)
    source = digest(body)
    own = {t: f"<urn:uuid:{uuid.uuid5(NAMESPACE, record_id + t)}>" for t in ("metadata", "conversion")}
    is_html, is_text = media in ("text/html", "application/xhtml+xml"), media.startswith("text/")
    page = ""
    if is_html or is_text:
        try:
            page = body.decode(charset[1] if charset else "utf-8", "replace")
        except LookupError:
            page = body.decode("utf-8", "replace")
    fields = [("status", status)] if status else []
    fields += [(f"source-header-{n.lower()}", v) for n, v in headers]
    fields += [("source-block-digest", digest(block)), ("source-payload-digest", source),
               ("source-payload-length", str(len(body)))]
    if is_html:
        title, lang = _TITLE.search(page), _LANG.search(page)
        fields += [("title", _one_line(title[1]))] if title else []
        fields += [("language", lang[1])] if lang else []
        fields += [("outlink", _one_line(next(filter(None, m.groups()), ""))) for m in _LINK.finditer(page)]
    if is_html or is_text:
        fields.append(("derived-conversion", own["conversion"]))
    yield ("metadata", own["metadata"], "application/warc-fields", source, "".join(f"{n}: {v}{CRLF}" for n, v in fields))
    if is_html or is_text:
        yield "conversion", own["conversion"], "text/plain; charset=utf-8", source, plain_text(page) if is_html else page


def derivatives(responses: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Response records (record_id, target_uri, date, block) -> metadata and conversion records.

    Columns: ``carry``, record_type, record_id, refers_to, target_uri, date, content_type,
    source_digest, block_digest, content_length (bytes), block.
    """
    frame = responses.select(F.struct("record_id", "target_uri", "date", *carry).alias("row"), "record_id", "block")
    row = frame.schema["row"].dataType.simpleString()
    text_batches(responses.sparkSession)
    names = ["record_type", "own_id", "content_type", "source_digest", "block", "block_digest", "content_length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([("row", pa.int64()), *((n, pa.string()) for n in names[:-1]), (names[-1], pa.int64())])

            def rows(batch=batch):
                for at, (rid, block) in enumerate(zip(batch.column(1).to_pylist(), utf8(batch, 2))):
                    for out in derive(rid or "", block):
                        raw = out[4].encode()
                        yield (at, *out, digest(raw), len(raw))

            for part in rebatched(rows(), schema, 1024):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(part.column(0)), *part.columns[1:]],
                                                 names=["row", *names])

    out = frame.mapInArrow(tidied(run), f"row {row}, {', '.join(f'{n} string' for n in names[:-1])}, content_length bigint")
    return out.select(*[F.col("row")[c].alias(c) for c in carry], "record_type", F.col("own_id").alias("record_id"),
                      F.col("row.record_id").alias("refers_to"), F.col("row.target_uri").alias("target_uri"),
                      F.col("row.date").alias("date"), "content_type", "source_digest", "block_digest", "content_length",
                      "block")


def responses(pages: DataFrame, date: str, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """Pages as response records: id_col, record_id, target_uri, date, block (an HTTP response)."""
    body = F.coalesce(F.col(html_col), F.lit(""))
    h = F.md5(F.concat_ws("\x01", F.col(id_col).cast("string"), F.col(url_col), F.sha1(body.cast("binary"))).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    rid = F.concat(F.lit("<urn:uuid:"), cut[0], F.lit("-"), cut[1], F.lit("-5"), cut[2], F.lit("-8"), cut[3], F.lit("-"),
                   cut[4], F.lit(">"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return pages.select(id_col, rid.alias("record_id"), F.col(url_col).alias("target_uri"), F.lit(date).alias("date"),
                        F.concat(head, body).cast("binary").alias("block"))


def _line(name: str, value: Column) -> Column:
    return F.when(value.isNull(), "").otherwise(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)))


def record_text(records: DataFrame) -> Column:
    """A derived record as WARC 1.1 text, without the two line ends that close it."""
    c = records
    return F.concat(F.lit("WARC/1.1\r\n"), _line("WARC-Type", c["record_type"]), _line("WARC-Record-ID", c["record_id"]),
                    _line("WARC-Refers-To", c["refers_to"]), _line("WARC-Target-URI", c["target_uri"]),
                    _line("WARC-Date", c["date"]), _line("WARC-Block-Digest", c["block_digest"]),
                    _line("Content-Type", c["content_type"]), _line("Content-Length", c["content_length"].cast("string")),
                    F.lit(CRLF), c["block"])


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """One WARC file per partition, written by Spark's text sink to any store Spark can write."""
    records.select(record_text(records).alias("value")).write.option("lineSep", CRLF * 2) \
        .option("compression", compression).text(path)
