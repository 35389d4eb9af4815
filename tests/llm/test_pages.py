"""Web archives and page text."""

import base64
import gzip
import hashlib
import html as html_module
import os
import random
import re
from collections import defaultdict
from urllib.parse import urlsplit

import pytest

from plazalens.llm import extract, warc
from plazalens.llm.files import Reader, Writer

COLUMNS = "page_id long, url string, html string, text string, file string, offset string"


@pytest.fixture(scope="module")
def pages(spark):
    return lambda rows: spark.createDataFrame([(*row, "x", "x", "x") for row in rows], COLUMNS)


def captures_of(rows):
    ids = defaultdict(list)
    for page, _, html in rows:
        ids[html or ""].append(page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        first = min((i for i in ids[html or ""] if i is not None), default=None)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        kind = "response" if page == first else "revisit"
        out.append((page, len(data), digest, kind, None if page == first else first))
    return sorted(out, key=repr)


def test_archive_round_trip(pages, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    rng = random.Random(2)
    urls = ["http://www.a.example/x", "https://www.a.example/x", "http://b.example:8080/p?q=é&r=\r\nX: y", "http://[bad", "", None]
    rows = [(i, rng.choice(urls), rng.choice([None, "", "é", "x" * rng.randrange(40)])) for i in range(400)]
    rows += [(3, urls[0], "twice")] * 2 + [(None, urls[0], "nameless"), (None, None, "x"), (5000, urls[1], "long é " * 50_000)]
    rows += [(6000, urls[0], "one page"), (6000, urls[1], "under two addresses")]
    got = warc.archive_and_read(pages(rows).repartition(5)).collect()
    assert sorted(map(tuple, got), key=repr) == captures_of(rows)
    assert warc.archive_and_read(pages([])).collect() == []


def test_archives_are_plain_warc(pages):
    rows = [(i, f"http://h{i % 3}.example/{i}", "same" if i % 2 else f"page {i}") for i in range(20)]
    folder, captures = warc.write_archive(pages(rows))
    path = urlsplit(folder).path
    names = os.listdir(path)
    assert names and all(name.endswith(".warc.gz") for name in names)
    records = 0
    for name in names:
        with gzip.open(f"{path}/{name}") as file:
            data = file.read()
        records += data.count(b"WARC/1.1\r\n")
        assert data.endswith(b"\r\n\r\n")
    assert records == captures.count() == 20


def test_only_looked_up_pages_are_read(pages):
    rows = [(i, f"http://h{i % 30}.example/{i}", f"page {i}") for i in range(900)]
    archive, captures = warc.write_archive(pages(rows))
    index = warc.build_index(captures)
    wanted = pages([rows[5], rows[700], (1, "http://nowhere.example/", ""), (5, rows[6][1], "")])
    got = warc.read_archive(wanted, archive, index).collect()
    assert sorted(row.page_id for row in got) == [5, 700]


@pytest.mark.parametrize(
    "url, key",
    [
        ("http://www.Example.com/a?b=c#d", "com,example,www)/a?b=c"),
        ("https://user@example.com:81", "com,example:81)/"),
        ("no host", "no host"),
        ("http://x:port/", "http://x:port/"),
        (None, ""),
    ],
)
def test_url_keys(url, key):
    assert warc.url_key(url) == key


def test_a_damaged_record_is_noticed():
    data = warc.record(1, "http://x/", b"payload", None)
    assert warc.parse(data).payload == b"payload"
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"payload", b"pAyload"))
    with pytest.raises(ValueError):
        warc.parse(b"x" + data)


def test_files_appear_when_they_are_complete(tmp_path):
    writer = Writer(f"file://{tmp_path}", "a")
    assert writer.write(b"abc") == 0 and writer.write(b"de") == 3
    assert not (tmp_path / "a").exists()
    writer.close()
    assert Reader(f"file:{tmp_path}").read("a", 1, 3) == b"bcd"
    with pytest.raises(EOFError):
        Reader(f"file:{tmp_path}").read("a", 4, 3)


# --- page text ---------------------------------------------------------------

BODY = "<p>First &amp; <b>bold</b>er text of some length, enough to be content.</p><p>No.</p>"
SAID = "First & bolder text of some length, enough to be content. No."
CASES = {
    "nothing": ("", ""),
    "no markup": ("just  text\nhere", "just text here"),
    "article": (f"<nav><a href=/>Menu</a></nav><article>{BODY}</article><footer>&copy; us, and a longer line of text here</footer>", SAID),
    "cut": (f"<html><body><article>{BODY}<p>Then &am", f"{SAID} Then &am"),
    "unclosed": (f"<article><h1>Title<p><b>Open.<br>Next{BODY}</article><footer>Foot", f"Title Open. Next {SAID}"),
    "side parts within": (
        f"<article><header><h1>Title</h1></header>{BODY}<div class='ad-box ad'>Buy</div><aside>See also</aside>"
        "<form>Name <input><button>Go</button></form><div id='comments'><p>A reader's comment that is very long indeed, really.</p></div>"
        "<script>var a='<p>x</p>';</script><style>p{}</style><p>End.</p></article>",
        f"Title {SAID} End.",
    ),
    "around": (
        "<header>Site name</header><div role=navigation>Here there</div><div class='cookie-notice'>We use cookies and so on</div>"
        f"<main>{BODY}</main><div class=sidebar>Other things to read in the sidebar</div>",
        SAID,
    ),
    "no article": (f"<div class=menu><a>One</a> <a>Two</a></div><div id=c>{BODY}</div><div><a href=x>Link</a></div>", SAID),
    "two articles": (f"<article>Teaser.</article><article>{BODY}</article>", SAID),
    "references": ("<article><p>&lt;p&gt; &eacute;&#233;&#x20AC; &nbsp; x &unknown; y</p></article>", "<p> éé€ x &unknown; y"),
    "hidden": ("<article><p>Seen words here.</p><p hidden>Not</p><p style='display: none'>Nor this</p></article>", "Seen words here."),
    "table": ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a b c"),
    "comment": ("<article><!-- not <p>this</p> --><p>But this one.</p></article>", "But this one."),
}


@pytest.mark.parametrize("name", CASES)
def test_main_text(name):
    html, text = CASES[name]
    assert extract.main_text(html) == text


@pytest.mark.parametrize(
    "html",
    [
        f"<body class='has-sidebar'><nav>Menu</nav><article>{BODY}</article></body>",
        f"<body><div class='content no-sidebar'><article>{BODY}</article></div><footer>Foot</footer></body>",
        f"<body class='single comments-open'><article class='post share'>{BODY}</article></body>",
        f"<form id=all><input><main class=widget>{BODY}</main></form>",
        f"<main><div class='content no-sidebar'>{BODY}</div></main>",
        f"<article>{BODY}<div class='ad'>Buy</div><form>Name <input></form></article>",
    ],
)
def test_a_mark_does_not_take_the_page(html):
    assert extract.main_text(html) == SAID


def test_pages_without_article_are_read_whole():
    short = [f"Paragraph {i} " + "of some words " * 10 for i in range(20)]
    items = ["See one", "See two"]
    body = "<h1>Title</h1>" + "".join(f"<p>{p}</p>" for p in short) + f"<p>{'long words ' * 450}</p>"
    body += "<ul>" + "".join(f"<li><a href=x>{i}</a></li>" for i in items) + "</ul>"
    html = f"<body><div><a href=/>Home</a> <a href=/b>Other</a></div><div id=c>{body}</div><div><a href=x>Link</a></div></body>"
    said = " ".join(["Title", *short, "long words " * 450, *items])
    assert extract.main_text(html) == " ".join(said.split())
    assert extract.main_text(f"<form><div class=no-sidebar><div id=c>{BODY}</div></div></form>") == SAID


def test_an_article_without_content_is_not_the_page():
    text = "Words of a longer paragraph that say what the page is about. " * 5
    body = "".join(f"<p>{text}</p>" for _ in range(6))
    html = f"<body><article><b><i>Hi</i></b></article><div><a>x</a><a>y</a></div><div><a>x</a><a>y</a></div><div id=c>{body}</div></body>"
    assert extract.main_text(html) == " ".join([text.strip()] * 6)


LONG = "A sentence of the page's own that says what it is about. " * 6
MORE = "What a reader thinks of it, at great length and without an end. " * 40
SAYS = LONG.strip()
OUTSIDE = {
    "comments longer than the article": (f"<article><p>{LONG}</p><div class='comments'><p>{MORE}</p><p>{MORE}</p></div></article>", SAYS),
    "comments as articles": (
        f"<article><p>{LONG}</p></article><ol class=comment-list><li><article id=comment-1><p>{MORE}</p></article></li></ol>",
        SAYS,
    ),
    "nothing but comments": (f"<div class=comments><p>{LONG}</p></div>", SAYS),
    "alert": (f"<article><p>{LONG}</p><div class='alert alert-info'>Our terms have changed.</div><p>{LONG}</p></article>", f"{SAYS} {SAYS}"),
    "menu without a name": (
        f"<article><p>{LONG}</p><div><a href=a>One</a> <a href=b>Two</a> <a href=c>Three</a></div><p>{LONG}</p></article>",
        f"{SAYS} {SAYS}",
    ),
    "links in a sentence": (
        f"<article><p>{LONG}</p><p>See <a href=a>One</a>, then <a href=b>Two</a> and also <a href=c>Three</a>.</p></article>",
        f"{SAYS} See One, then Two and also Three.",
    ),
    "nothing but links": ("<article><ul><li><a>One</a><li><a>Two</a><li><a>Three</a></ul></article>", "One Two Three"),
    "price": (f"<article><p>{LONG}</p><p class='share-price'>Down 3 %.</p></article>", f"{SAYS} Down 3 %."),
    "two articles of a page": (
        f"<article><p>{LONG}</p></article><nav>Menu</nav><article><p>{LONG * 3}</p></article>",
        " ".join([SAYS] * 4),
    ),
    "advert longer than the article": (f"<div class=ad>{LONG}</div><article><h1>Hi.</h1><p><b>Hi.</article>", "Hi. Hi."),
    "inline advert": (f"<article><p>{LONG}<span class=ad>Buy now</span> More.</p></article>", f"{SAYS} More."),
    "names": (f"<article><p>{LONG}</p><div class=adBox>Buy</div><p class=ad-free>Kept</p><p id=NoAds>Kept too</p></article>", f"{SAYS} Kept Kept too"),
    "no article, sidebar holds less": (
        f"<div class=wrap><div id=c><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></div><div class=widget><p>{LONG}</p></div></div>",
        f"Title {SAYS} {SAYS}",
    ),
}


@pytest.mark.parametrize("name", OUTSIDE)
def test_content_decides(name):
    html, text = OUTSIDE[name]
    assert extract.main_text(html) == text


def test_ratios_select_the_region(monkeypatch):
    """With the ratios turned round, short lines are content and prose is not."""
    body = "".join(f"<p>{LONG}</p>" for _ in range(4))
    items = "".join(f"<div><b><i>{i}</i></b></div>" for i in range(6))
    pages = [OUTSIDE["menu without a name"][0], f"<div id=a>{items}</div><div id=b>{body}</div>", f"<article>{items}</article><article>{body}</article>"]
    before = [extract.main_text(html) for html in pages]
    smoothed = extract.smoothed
    monkeypatch.setattr(extract, "smoothed", lambda values: -smoothed(values))
    assert [a != extract.main_text(html) for a, html in zip(before, pages)] == [True] * 3


def test_deep_and_unclosed_pages_take_linear_work():
    n = 50_000
    assert extract.main_text("<div class=ad>" * 3 + "<div>" * n + "words") == "words"
    assert extract.main_text("<b>" * n + "</i>" * n + "<hr>" * n + "words") == "words"
    assert extract.main_text("<article>" + "<b><p>x" * n) == " ".join("x" * n)


def test_extract(pages):
    rows = [(1, "u", CASES["article"][0]), (1, "u", CASES["article"][0]), (None, None, None), (2, None, ""), (3, "v", "<article>é" + "<p>word" * 20_000)]
    got = extract.extract(pages(rows)).collect()
    expected = [(1, "u", SAID), (1, "u", SAID), (None, None, ""), (2, None, ""), (3, "v", "é" + " word" * 20_000)]
    assert sorted(map(tuple, got), key=repr) == sorted([(*row, len(row[2])) for row in expected], key=repr)
    assert extract.extract(pages([])).collect() == []


def test_the_articles_of_the_driver_pages(spark):
    path = "/root/testdata/sf0.001/pages.parquet"
    if not os.path.exists(path):
        pytest.skip("no driver tables")
    for row in spark.read.parquet(path).collect():
        (article,) = re.findall(r"(?s)<article>(.*?)(?:</article>|$)", row.html)
        words = html_module.unescape(re.sub(r"<[^>]*>", " ", article)).split()
        assert extract.main_text(row.html) == " ".join(words)


def test_ratios_are_smoothed_and_split():
    import numpy as np

    flat = np.full(9, 5.0)
    assert np.allclose(extract.smoothed(flat), flat)
    spike = np.zeros(9)
    spike[4] = 1
    out = extract.smoothed(spike)
    assert out.argmax() == 4 and np.allclose(out, out[::-1])
    assert 1 < extract.threshold(np.array([0.0, 0.5, 1.0, 9.0, 10.0, 11.0])) < 9
