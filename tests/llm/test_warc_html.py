from __future__ import annotations

import hashlib
import os

import duckdb
import pytest

from bankmart.llm import queries
from bankmart.llm.html_extract import extract_main_text, main_text
from bankmart.llm.warc import candidates_of, read_warc, round_trip, write_warc

FAKE = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:7>\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\ny"


def test_round_trip_edge_cases(spark):
    big = "é" * 600
    pages = [(1, "u", FAKE), (2, None, None), (3, "a\r\nb", ""), (4, "u", big), (5, "u", big), (6, "u", big), (7, "u", "x" * 999),
             (8, "u", "x" * 999), (9, "u", "z" * 300_000), (None, "u", "null id"), (10, "u", "\r\n\r\n"), (11, "u", "WARC/1.1\r\n")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 digest", "'x' kept")
    got = {r.page_id: r for r in round_trip(df).collect()}
    assert len(got) == len(pages)
    for i, _, h in pages:
        raw = (h or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
        assert (got[i].record_type, got[i].refers_to) == (("revisit", 6) if i in (4, 5) else ("response", None))
    assert round_trip(df.limit(0)).collect() == []


def test_magic_inside_payload_is_only_a_candidate(spark, scratch):
    df = spark.createDataFrame([(i, "u", FAKE * (i % 3)) for i in range(40)], "page_id long, url string, html string")
    write_warc(df.coalesce(1), f"{scratch}/w")
    files = spark.read.format("binaryFile").load(f"{scratch}/w").collect()
    assert sum(len(list(candidates_of(f.path, bytes(f.content)))) for f in files) > 40
    assert sorted(r.page_id for r in read_warc(spark, f"{scratch}/w").collect()) == list(range(40))


def test_pages_of_one_id_with_different_payloads(spark):
    a, b = "a" * 2000, "b" * 3000
    df = spark.createDataFrame([(1, "u", a), (5, "u", a), (5, "u", b), (2, "u", b), (9, "u", a), (9, "u", a)], "page_id long, url string, html string")
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest[:4], r.record_type, r.refers_to) for r in round_trip(df).collect())
    x, y = (hashlib.sha1(t.encode()).hexdigest()[:4] for t in (a, b))
    assert got == sorted([(1, 2000, x, "revisit", 9), (5, 2000, x, "revisit", 9), (5, 3000, y, "response", None), (2, 3000, y, "revisit", 5),
                          (9, 2000, x, "response", None), (9, 2000, x, "response", None)], key=lambda r: r[:4])


def test_a_chain_that_breaks_fails_the_read(spark, scratch):
    write_warc(spark.createDataFrame([(i, "u", "text") for i in range(9)], "page_id long, url string, html string").coalesce(1), f"{scratch}/w")
    part, = [f for f in os.listdir(f"{scratch}/w") if f.startswith("part-")]
    with open(f"{scratch}/w/{part}", "rb") as fh:
        raw = fh.read()
    os.makedirs(f"{scratch}/cut")
    with open(f"{scratch}/cut/a.warc", "wb") as fh:
        fh.write(raw[:-7])
    with pytest.raises(ValueError, match="a.warc"):
        read_warc(spark, f"{scratch}/cut")


def test_many_repeated_payloads(spark):
    df = spark.range(3000).selectExpr("id as page_id", "'u' as url", "repeat(cast(id % 700 as string) || '-', 600) as html")
    got = round_trip(df).collect()
    assert len(got) == 3000
    assert all((r.refers_to or r.page_id) % 700 == r.page_id % 700 and (r.record_type == "response") == (r.page_id + 700 >= 3000) for r in got)
    assert all(r.payload_digest == hashlib.sha1(f"{r.page_id % 700}-".encode() * 600).hexdigest() for r in got)


def test_warc_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view pages as from '{sf}/pages.parquet'")
    want = con.sql(queries.ORACLE_SQL["op8_warc"]).fetchall()
    assert sorted(map(tuple, queries.op8_warc(spark, sf).collect())) == sorted(want)


def test_main_text():
    page = ('<html><head><title>t</title><script>var a="</p>";</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href="/">'
            'Home</a></ul></nav><div class="cookie-notice">We use cookies</div><div class="ad">Buy</div><article><h1>A &amp; B</h1><p>One  \n'
            '<b>two</b><br>three<p>Short.<aside>side</aside><form><input><label>mail</label></form><p>x &lt; y<div class="comments"><p>first!'
            '</div></article><footer>&copy; me</footer></body></html>')
    assert main_text(page) == "A & B\n\nOne two three\n\nShort.\n\nx < y"
    plain = ('<body><ul class="menu"><li><a href="/">a</a></ul><div id="content"><p>' + "long text " * 30 + "</p><p>tiny</p><p>"
             + "more text " * 30 + '</p></div><div id="footer">foot</div></body>')
    assert main_text(plain).split("\n\n")[1] == "tiny" and "foot" not in main_text(plain)
    assert main_text(None) == main_text("") == "" and main_text("a < b") == "a < b"
    assert main_text("<article><p>cut &am") == "cut &am" and main_text("<article><p>cut<p cla") == "cut"


def test_articles_of_the_table(spark):
    import html as h
    import re

    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in df.collect():
        body = re.split(r"</article>|<footer>|<footer$", (r.html or "").partition("<article>")[2])[0]
        body = re.sub(r"<[^>]*\Z", "", body)
        blocks = [" ".join(h.unescape(re.sub(r"<[^>]+>", " " if "<br>" in b else "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        want[r.page_id] = "\n\n".join(b for b in blocks if b)
    got = {r.page_id: r.text for r in extract_main_text(df.withColumnRenamed("url", "x").selectExpr("*", "'u' url", "1 text")).collect()}
    assert got == want


LONG = "Main text in sentences of a page that has some length, told at leisure. " * 4


def paragraphs(n, name="div"):
    return [f"{i} {LONG}".strip() for i in range(n)], "".join(f"<{name}>{i} {LONG}</{name}>" for i in range(n))


def test_a_teaser_is_not_the_main_text():
    want, body = paragraphs(6)
    page = f'<body><nav><a href="/">Home</a></nav><div>{body}</div><article><h3>Read next</h3><p>A teaser.</p></article><footer>me</footer>'
    assert main_text(page).split("\n\n") == want
    assert main_text(page.replace("article", "main")).split("\n\n") == want


def test_windows_choose_beside_an_article():
    want, body = paragraphs(6, "p")
    page = f"<body><div>Your edition: world</div><article>{body}</article><div>Terms of use</div><div><a href='/'>{LONG}</a></div></body>"
    assert main_text(page).split("\n\n") == want


def test_an_article_is_not_parted_by_what_is_set_aside_in_it():
    want, body = paragraphs(3, "p")
    aside = "<aside><p>a<p>b<p>c<p>d</aside>"
    assert main_text(f"<article>{body}{aside}<p>End.</p></article>").split("\n\n") == [*want, "End."]


def test_unmarked_pages_with_one_long_paragraph():
    links = "".join(f"<p><a href='/{i}'>link {i}</a></p>" for i in range(4))
    short = "A paragraph of ordinary length that stands by itself between links, some eighty characters and more."
    long = (LONG * 30).strip()
    page = f"<body><div>{short}</div>{links}<div>{long}</div>{links}<div>{short}</div>{links}<div>Tiny note</div></body>"
    assert main_text(page).split("\n\n") == [short, long, short]


def test_names_only_hint():
    want, body = paragraphs(5, "p")
    for wrapper in ('<div id="wrapper" class="has-sidebar">', '<div class="layout sidebar-right">', '<div class="sidebar">', '<section class="page-header main">',
                    '<div class="widget"><div class="content">'):
        assert main_text(f"<body>{wrapper}<nav>x</nav>{body}<div class='related-articles'><p>Read next</p></div></div></body>").split("\n\n") == want, wrapper
        assert main_text(f"<body>{wrapper}<article>{body}</article><p>x</p></div>").split("\n\n") == want, wrapper
    page = f'<article><div class="entry-header"><h1>Title</h1></div>{body}<p class="alert">{LONG}</p><section id="social-impact"><p>{LONG}</p></section></article>'
    assert main_text(page).split("\n\n") == ["Title", *want, LONG.strip(), LONG.strip()]


@pytest.mark.parametrize("part", [
    '<div class="share-buttons"><p>Share</p></div>', '<div id="comments"><p>first!</p></div>', '<div class="ad-slot top">Buy</div>', '<p class="advert">Buy</p>',
    '<div class="cookieConsent">We use cookies</div>', '<div class="newsletter-signup"><p>Your mail</p></div>', '<ul class="breadcrumbs"><li>Home</ul>',
    '<div role="complementary"><p>x</p></div>', '<div hidden><p>x</p></div>', '<section class="related-posts"><p>Read next</p></section>',
    '<div class="comment-list">' + "<p>A long comment that says much more than what it comments on ever did.</p>" * 60 + "</div>"])
def test_parts_that_go(part):
    want, body = paragraphs(3, "p")
    assert main_text(f"<body><article>{body}{part}</article></body>").split("\n\n") == want
    assert main_text(f"<body><div><div>{body}</div></div>{part}</body>").split("\n\n") == want


def test_attributes_as_the_language_has_them():
    want, body = paragraphs(2, "p")
    assert main_text(f"<article><p alt=it's>One.</p>{body}<p title='a > b' x=\"'\">Two.</p><p a'b>Three.</p><p href=/a?b=c\"d>Four.</p></article>"
                     ).split("\n\n") == ["One.", *want, "Two.", "Three.", "Four."]
    assert main_text(f'<article>{body}<p class = "ad" >Buy</p><p class=ad>Buy</p></article>').split("\n\n") == want
    assert main_text(f'<article>{body}<p title="never closed>x</p></article>').split("\n\n")[:2] == want
    assert main_text(f"<article>{body}<p>The sum <math><mi>a</mi><mo>+</mo><mn>1</mn></math> is here.</p></article>").split("\n\n")[-1] == "The sum a+1 is here."


def test_deep_and_long_pages_take_time_in_proportion():
    import time

    took = []
    for n in (4000, 16000):
        page = "<div class='ad-slot'>".join(f"<div><span>{i}" for i in range(n)) + LONG * n + "<p " + "x" * n + " = " * n
        at = time.process_time()
        main_text(page)
        took.append(time.process_time() - at)
    assert took[1] < 10 * took[0] + 0.5
