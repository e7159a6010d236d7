from __future__ import annotations

import gzip
import html as entities
import re
import time
import zlib

import pytest

from salestide.llm import dom, html_extract, queries, warc
from tests.llm import plain


@pytest.fixture(scope="module")
def crf():
    return html_extract.trained_field()


def test_held_out_pages(crf):
    grammar, wrong, count = html_extract.Grammar(99), 0, 0
    for _ in range(150):
        blocks, labels = grammar.page()
        made = crf.decode(html_extract.features(blocks)) if blocks else []
        wrong += sum(a != b for a, b in zip(labels, made))
        count += len(labels)
    assert wrong <= 0.01 * count


def test_viterbi_finds_the_best_chain_and_chances_add_up(crf):
    grammar = html_extract.Grammar(5)
    for _ in range(20):
        page = html_extract.features(grammar.page()[0])[:9]
        if not page:
            continue
        scores = crf.scores(page)

        def value(labels):
            own = sum(s for s, y in zip(scores, labels) if y)
            return own + sum(crf.pairs[a][b] for a, b in zip(labels, labels[1:]))

        chains = [[(n >> k) & 1 for k in range(len(page))] for n in range(2 ** len(page))]
        assert value(crf.decode(page)) == pytest.approx(max(map(value, chains)))
        main, steps = crf.expected(page)
        assert all(-1e-9 <= p <= 1 + 1e-9 for p in main)
        assert all(sum(map(sum, step)) == pytest.approx(1) for step in steps)


def article(page):
    """The article of a page of the small table, by its own marks."""
    inner = re.search(r"<article>(.*?)(?:</article>|<footer>)", page, re.S).group(1)
    inner = re.sub(r"<br>", " ", re.sub(r"</?b>", "", inner))
    parts = [" ".join(entities.unescape(x).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(filter(None, parts))


def test_the_small_table(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{plain.FOLDER}/pages.parquet").collect()}
    made = queries.page_text(spark, plain.FOLDER).collect()
    assert {r.page_id for r in made} == set(pages)
    for r in made:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text)
        assert r.url == pages[r.page_id].url


def test_what_does_not_belong_to_the_article(crf):
    page = """<html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
    <header><h1>Site name</h1></header><nav><ul><li><a href=/>Home</a><li><a href=/b>Blog</a></ul></nav>
    <div class="cookie-notice">We use cookies. <button>Accept</button></div>
    <article><h1>A title</h1><p>First &amp; second&nbsp;words   here, in a sentence that goes on for a while.
    <p>Short.</p><div class="ad">Buy these wonderful shoes today at half the price!</div>
    <p>Last words of it, with <a href=/x>a link</a> inside.</p></article>
    <section id="comments"><p>What a very nice article, I read all of it twice!</p></section>
    <aside><h3>Related</h3><p>Other things that you may like to read.</p></aside>
    <form><label>Your mail</label><input><button>Subscribe</button></form><footer>&copy; Site</footer></body></html>"""
    assert html_extract.main_text(page, crf).split("\n") == [
        "A title", "First & second words here, in a sentence that goes on for a while.", "Short.",
        "Last words of it, with a link inside.",
    ]


EDGES = [None, "", "just text", "<p", "<p>a<p>b</div></p>&lt;c", "<<<>>><!-- x", "<div>" * 3000 + "deep", "<article><p>" + "x " * 100_000]


def test_edges(spark):
    rows = [(i, None if i else "u", t, "x", "y") for i, t in enumerate(EDGES)] + [(None, None, None, "x", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars string")
    made = html_extract.extract_pages(pages).collect()
    got = {r.page_id: r for r in made}
    assert len(made) == len(rows) and got[0].text == "" and got[0].n_chars == 0 and got[None].text == ""
    assert got[7].n_chars == 199_999
    assert html_extract.extract_pages(pages.limit(0)).collect() == []
    records = warc.derivatives(warc.responses(pages)).collect()
    assert len(records) == 2 * len(rows)
    assert {r.record_type for r in records} == {"metadata", "conversion"}
    assert warc.derivatives(warc.responses(pages.limit(0))).collect() == []


def test_blocks_know_their_ancestors():
    page = dom.read_page('<div class="Post-Body x"><ul><li>one<li><a href="/l">two</a></ul>tail</div>', {"post": "main", "x": "ad"})
    assert [(b.text, b.leaf, b.linked) for b in page.blocks] == [("one", "li", 0), ("two", "li", 1.0), ("tail", "div", 0)]
    assert page.blocks[0].names == {"main", "ad"} and page.links == ["/l"]
    assert page.blocks[0].inside == {"div", "ul", "li"} and page.blocks[2].inside == {"div"}


@pytest.mark.parametrize("tag", ["<div>", "<b>x", "<a href=/x>y", "<my-{}>", "<p><div class=post>z", "<title>", "</b><b>w", "<li><i>"])
def test_time_grows_with_the_page_not_with_its_depth(crf, tag):
    def seconds(count):
        page = "<article><p>start " + "".join(tag.replace("{}", str(k)) + "w " for k in range(count))
        begin = time.process_time()
        html_extract.main_text(page, crf)
        ((_, block, _), _) = warc.derive({}, b"HTTP/1.1 200 OK\r\n\r\n" + page.encode())
        return time.process_time() - begin

    seconds(500)
    # Eight times the tags: far from 64 times the time.
    assert seconds(64_000) < 24 * max(seconds(8_000), 0.05)


def message(*headers, body=b"<p>caf\xc3\xa9</p>", drop=(), **more):
    block = "\r\n".join(["HTTP/1.1 200 OK", *headers, "", ""]).encode("latin-1") + body
    fields = {"WARC-Type": "response", "WARC-Record-ID": "<urn:x>", "WARC-Target-URI": "http://h/", "Content-Length": str(len(block))} | more
    lines = [f"{n}: {v}" for n, v in fields.items() if n not in drop]
    return "\r\n".join([warc.VERSION, *lines, "", ""]).encode() + block + b"\r\n\r\n"


def text_of(data):
    _, (headers, block, whole) = warc.derive(*warc.read_response(data))
    assert warc.parse(whole) == [(headers, block)]
    return block.decode()


def test_bodies_are_decoded_as_their_headers_say():
    latin, chunked = "<p>café</p>".encode("latin-1"), b"8\r\n<p>caf\xc3\xa9\r\n4;x=y\r\n</p>\r\n0\r\n\r\n"
    packed, raw = gzip.compress(b"<p>caf\xc3\xa9</p>"), zlib.compress(b"<p>caf\xc3\xa9</p>")[2:-4]
    assert text_of(message()) == "café"
    assert text_of(message("Content-Type: text/html; charset=iso-8859-1", body=latin)) == "café"
    assert text_of(message("content-type:text/html;charset='latin1'", body=latin)) == "café"
    assert text_of(message("Content-Type: text/html", body=b"<meta charset=latin1>" + latin)) == "café"
    assert text_of(message("Transfer-Encoding: chunked", body=chunked)) == "café"
    assert text_of(message("Content-Encoding: gzip", body=packed)) == "café"
    assert text_of(message("Content-Encoding: deflate", body=raw)) == "café"
    whole = b"%x\r\n%s\r\n0\r\n\r\n" % (len(packed), packed)
    assert text_of(message("Transfer-Encoding: chunked", "Content-Encoding: gzip", body=whole)) == "café"
    assert text_of(message("Content-Type: text/plain", body=b"a <b> c")) == "a <b> c"
    assert text_of(message("Content-Type: image/png", body=b"\x89PNG")) == ""
    # What does not follow its headers is taken as it is.
    assert text_of(message("Transfer-Encoding: chunked")) == "café"
    assert text_of(message("Content-Encoding: gzip")) == "café"
    assert text_of(message("Content-Type: text/html; charset=nonsense")) == "café"


def test_optional_headers_and_broken_records(spark):
    good = message("Content-Type:text/html", drop=())
    (headers, block, _), (conversion, _, _) = warc.derive(*warc.read_response(good))
    assert f"source-payload-digest: {warc.digest(b'<p>caf' + bytes([0xC3, 0xA9]) + b'</p>')}" in block.decode()
    assert conversion["WARC-Source-Content-Type"] == "text/html" and headers["WARC-Refers-To"] == "<urn:x>"
    rows = [(1, good), (2, b"no record"), (3, b""), (4, message(drop=("Content-Length",))), (5, good[:-9]), (6, None), (7, good + good)]
    rows += [(8, message(**{"WARC-Type": "request"})), (9, message(drop=("WARC-Record-ID", "WARC-Target-URI")))]
    made = warc.derivatives(spark.createDataFrame(rows, "page_id long, response binary")).collect()
    kinds = {}
    for r in made:
        kinds.setdefault(r.page_id, []).append((r.record_type, r.error is None))
    assert kinds[1] == kinds[9] == [("metadata", True), ("conversion", True)]
    assert all(kinds[k] == [("error", False)] for k in (2, 3, 4, 5, 7, 8)) and 6 not in kinds


def test_records_come_back(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{plain.FOLDER}/pages.parquet").collect()}
    frame = spark.read.parquet(f"{plain.FOLDER}/pages.parquet")
    sources = {r.page_id: bytes(r.response) for r in warc.responses(frame).collect()}
    made = warc.derivatives(warc.responses(frame)).collect()
    assert len(made) == 2 * len(pages)
    for r in made:
        ((headers, block),) = warc.parse(bytes(r.record))
        ((own, message),) = warc.parse(sources[r.page_id])
        page = pages[r.page_id]
        payload = message.partition(b"\r\n\r\n")[2]
        assert payload == page.html.encode() and own["WARC-Payload-Digest"] == warc.digest(payload)
        assert headers["WARC-Refers-To"] == own["WARC-Record-ID"] == r.refers_to
        assert headers["WARC-Block-Digest"] == warc.digest(block) == r.block_digest
        assert headers["WARC-Target-URI"] == page.url and headers["WARC-Record-ID"] == r.record_id
        assert headers["WARC-Source-Content-Type"] == "text/html; charset=utf-8"
        if r.record_type == "conversion":
            assert block.decode() == "\n".join(b.text for b in dom.read_page(page.html).blocks)
        else:
            fields = block.decode()
            assert f"source-payload-digest: {own['WARC-Payload-Digest']}\r\n" in fields
            assert "http-header: Content-Type: text/html; charset=utf-8\r\n" in fields
    assert len({r.record_id for r in made}) == len(made)
    whole = b"".join(bytes(r.record) for r in made)
    assert len(warc.parse(whole)) == len(made)


def test_line_breaks_forge_no_headers():
    data = warc.response("1", "http://a\r\nWARC-Type: warcinfo", "<title>x\r\ny</title>")
    ((headers, _),) = warc.parse(data)
    assert headers["WARC-Type"] == "response"
    for parsed, _, whole in warc.derive(*warc.read_response(data)):
        assert warc.parse(whole)[0][0] == parsed and parsed["WARC-Refers-To"] == headers["WARC-Record-ID"]
    with pytest.raises(ValueError):
        warc.read_response(warc.derive(*warc.read_response(data))[0][2])
