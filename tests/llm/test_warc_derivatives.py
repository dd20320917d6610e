"""Derived WARC records: links, digests, text against an HTML parser, files read back by length."""

import base64
import glob
import gzip
import hashlib
from html.parser import HTMLParser

from courtside.llm.common import table
from courtside.llm.warc_derivatives import derivatives, plain_text, responses, split_response, write_warc

SF = "/root/testdata/sf0.001"
LINES = {"p", "div", "br", "li", "ul", "ol", "nav", "main", "article", "section", "header", "footer", "table", "tr", "td",
         "th", "h1", "h2", "h3", "h4", "h5", "h6", "aside", "pre", "blockquote", "form", "hr", "figure"}


class Text(HTMLParser):
    def __init__(self):
        super().__init__()
        self.out, self.depth = [], 0

    def handle_starttag(self, tag, attrs):
        self.depth += tag in ("script", "style", "title", "head", "noscript", "template")
        self.out.append("\n" if tag in LINES else "")

    def handle_endtag(self, tag):
        self.depth -= tag in ("script", "style", "title", "head", "noscript", "template")
        self.out.append("\n" if tag in LINES else "")

    def handle_data(self, data):
        if not self.depth:
            self.out.append(data)


def brute_text(page):
    p = Text()
    p.feed(page)
    p.close()
    return [" ".join(x.split()) for x in "".join(p.out).split("\n") if x.split()]


def sha(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def records_of(data):
    """WARC records by their Content-Length."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head, *lines = data[at:end].decode().split("\r\n")
        assert head == "WARC/1.1"
        fields = dict(x.split(": ", 1) for x in lines)
        n = int(fields["Content-Length"])
        block = data[end + 4:end + 4 + n]
        at = end + 4 + n
        assert data[at:at + 4] == b"\r\n\r\n"
        at += 4
        yield fields, block


def test_pages_and_files(spark, tmp_path):
    pages = table(spark, SF, "pages")
    source = responses(pages, "2026-01-01T00:00:00Z")
    out = derivatives(source, carry=("page_id",))
    by_page = {r["page_id"]: r for r in pages.collect()}
    ids = {r["page_id"]: r for r in source.collect()}
    rows = out.collect()
    assert len(rows) == 2 * len(by_page) and len({r["record_id"] for r in rows}) == len(rows)
    conversion = {r["page_id"]: r["record_id"] for r in rows if r["record_type"] == "conversion"}
    for r in rows:
        page, raw = by_page[r["page_id"]], r["block"].encode()
        assert r["refers_to"] == ids[r["page_id"]]["record_id"] and r["target_uri"] == page["url"]
        assert r["block_digest"] == sha(raw) and r["content_length"] == len(raw)
        assert r["source_digest"] == sha(page["html"].encode())
        if r["record_type"] == "conversion":
            assert [" ".join(x.split()) for x in r["block"].split("\n")] == brute_text(page["html"]) or not r["block"]
        else:
            fields = [x.split(": ", 1) for x in r["block"].split("\r\n") if x]
            assert ["source-header-content-type", "text/html; charset=utf-8"] in fields
            assert ["derived-conversion", conversion[r["page_id"]]] in fields
            assert ["source-block-digest", sha(bytes(ids[r["page_id"]]["block"]))] in fields
    write_warc(out, str(tmp_path / "w"))
    read = [x for f in glob.glob(str(tmp_path / "w/part-*")) for x in records_of(gzip.open(f).read())]
    want = sorted((r["record_id"], r["refers_to"], r["block"].encode()) for r in rows)
    assert sorted((f["WARC-Record-ID"], f["WARC-Refers-To"], b) for f, b in read) == want
    again = derivatives(responses(pages, "2026-01-01T00:00:00Z"), carry=("page_id",)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_odd_html():
    assert plain_text("a<b>c</b>d<p>e<br/>f") == "acd\ne\nf"
    assert plain_text("<p title='x > y'>t</p><!-- <p>no</p> -->&lt;b&gt; &amp;amp; 1 < 2") == "t\n<b> &amp; 1 < 2"
    assert plain_text("<script>var t='</p>';</script>x<STYLE>p{}</STYLE >y<script>open") == "x y"
    assert plain_text('<p a="never closed>x</p>') == "x"
    assert plain_text("") == plain_text("<head>" + "z" * 100_000) == ""
    assert split_response(b"HTTP/1.0 200\r\nA: b: c\r\nbad\r\n\r\nbody\r\n\r\nmore") == \
        ("HTTP/1.0 200", [("A", "b: c"), ("bad", "")], b"body\r\n\r\nmore")


def test_missing_closing_tags():
    assert plain_text("<html><head><title>T</title><meta charset=x><body><p>all of it</p>") == "all of it"
    assert plain_text("<HEAD><script>a<b</script><link rel=x><h1>one</h1>two") == "one\ntwo"
    assert plain_text("<head><title>T</title>plain text<script>no</script> and more") == "plain text and more"
    assert plain_text("<head><style>p{}</style>stray</head><body>x</body>") == "x"
    assert plain_text("<head><meta a><body>x<script>'</head>'</script>y") == "x y"
    assert plain_text("<header>a</header><head>b</head>c") == "a\nc"
    assert plain_text("a<svg width='1'/>b<iframe src='u' />c<svg><text>no</text></svg>d") == "a b c d"
    assert plain_text("a<svg/>b<svg><text>no</text></svg>c") == "a b c"
    assert plain_text("a<iframe src=u/>no</iframe>b<iframe src=u/>c<svg>d<noscript>e<template>f") == "a b c d e f"
    assert plain_text("a<title>open<p>b") == plain_text("a<style>open<p>b") == "a"
    assert plain_text("<head><meta>x" * 20_000 + "<svg>" * 50_000).split() == ["x"] * 20_000


def test_edges(spark):
    rows = [("r1", "http://a", "d", b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n\x89PNG"),
            ("r2", None, "d", b"HTTP/1.1 200 OK\r\nContent-Type: text/plain; charset=latin-1\r\n\r\n\xe9 <p>"),
            ("r3", "u", "d", None), ("r4", "u", "d", b"<p>bare \xff</p>"), ("r4", "u", "d", b"<p>bare \xff</p>"),
            (None, None, None, b"HTTP/1.1 404 Not Found\r\nContent-Type: text/html; charset=none-such\r\n\r\n<p>gone")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "record_id string, target_uri string, date string, block binary, "
                                                              "record_type string")
    got = derivatives(frame).collect()
    text = {(r["refers_to"], r["block"]) for r in got if r["record_type"] == "conversion"}
    assert text == {("r2", "é <p>"), ("r3", ""), ("r4", "bare �"), (None, "gone")}
    assert len(got) == 11 and len([r for r in got if r["refers_to"] == "r1"]) == 1
    assert derivatives(frame.limit(0)).count() == 0
