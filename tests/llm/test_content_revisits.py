import html
import itertools
import random
import re

import pytest

from daygrain.llm import content as C
from daygrain.llm import revisits as R
from cases import stored

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body><header class=top><h1>Site name</h1></header>
<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>About us</a></ul></nav><div class="cookie-notice"><p>We use cookies here, please
accept all of them before you go on.</p></div><div id=main><article><header><h2>The  story&nbsp;&amp; more</h2></header>
<p>First <b>para</b>graph of the story,<br>with a good number of words in it to be kept.<p>Second &#233;t&eacute; paragraph, with
more of the words that belong to the story.<script>if (a < b) "</p>"</script><!-- <p>not this</p> --></p>
<aside><p>Read also these other stories that we have found for you today.</p></aside></article></div>
<form><label>Your name</label><input name=q></form><div class="comments"><p>A reader says something long enough to look like a paragraph.</p></div>
<div class=ad>Buy now</div><footer>&copy; Site</footer></body></html>"""


def test_page():
    want = [
        "The story & more", "First paragraph of the story, with a good number of words in it to be kept.",
        "Second été paragraph, with more of the words that belong to the story.",
    ]
    assert C.content_blocks(PAGE) == want


STORY = "A paragraph of the story, with a good number of words in it to be kept, and some more of them."
OTHER = "What a reader or an editor has put beside the story, long enough to look like one of its paragraphs."
BEFORE = "<html><head><title>x</title></head><body><article>"


@pytest.mark.parametrize("start", [
    "<html><head><title>x</title><body><article>", "<head><meta charset=utf-8><title>x</title><article>", "<head><title>x<body><article>",
    *(BEFORE + f"<{x} class=menu>" for x in ("noscript", "object", "svg", "button", "iframe", "canvas", "template", "math")),
    BEFORE + "<button>", BEFORE + "<svg/>", BEFORE + "<select><option>One<option>Two</select>", BEFORE + "<select><option>One<option>Two",
    BEFORE + "<object><object></object></object>", '<html class="cookies"><body class="no-sidebar"><main class="menu-page"><article class="has-comments">',
])
def test_unclosed_elements_and_words_of_the_whole_page_lose_no_text(start):
    assert C.content_blocks(f"{start}<p>{STORY}<p>{STORY}<button>Send</button><footer>Menu</footer>") == [STORY, STORY]
    assert C.content_blocks(f"{BEFORE}<p>{STORY}<script>x<p>{STORY}") == [STORY]


@pytest.mark.parametrize("wrapper", ['div class="site has-sidebar"', 'div class="layout-with-sidebar"', 'div id="page" class="share-enabled"', "section class=header-top"])
@pytest.mark.parametrize("part", ["article", "main"])
def test_class_words_of_a_wrapper_do_not_sink_the_page(wrapper, part):
    page = (
        f"<body><{wrapper}><nav><a href=/>Home</a></nav><{part}><p>{STORY}<p>{STORY}</{part}><div class=sidebar><p>{OTHER}</div>"
        f"<div class=comments><article class=comment><p>{OTHER}</article></div></{wrapper.split()[0]}>"
    )
    assert C.content_blocks(page) == [STORY, STORY]


def test_long_comments_stay_out():
    comments = "".join(f"<article class=comment><p>{OTHER}</article>" for _ in range(9))
    assert C.content_blocks(f"<body><article><p>{STORY}<p>{STORY}</article><div class=comments>{comments}</div>") == [STORY, STORY]


@pytest.mark.parametrize("page", ["", "<p>", "<", "<!--", "<script>x", "<a b='", "&amp;", "<p></p></p></div>", "<" * 5000, "<p>" * 3000])
def test_broken_pages(page):
    assert isinstance(C.content_blocks(page), list)


def test_cut_is_minimal():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randrange(1, 9)
        excess = [rng.randrange(-9, 10) for _ in range(n)]
        edges = [(a, b, rng.randrange(1, 6)) for a in range(n) for b in range(a) if rng.random() < 0.5]

        def cost(keep, excess=excess, edges=edges):
            own = sum(max(e, 0) if not k else max(-e, 0) for e, k in zip(excess, keep, strict=True))
            return own + sum(c for a, b, c in edges if keep[a] != keep[b])

        found = C.minimum_cut(list(excess), edges)
        assert cost(found) == min(map(cost, itertools.product([False, True], repeat=n)))


def test_pages_table(spark):
    rows = [(1, "u", PAGE, 5), (2, None, None, None), (None, "v", "", 1), (1, "u", PAGE, 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, blocks int")
    got = sorted(((r.row.page_id or 0, len(r.blocks)) for r in C.main_text(pages).collect()))
    assert got == [(0, 0), (1, 3), (1, 3), (2, 0)]
    assert C.main_text(pages.where("false")).count() == 0


def test_sample_pages_give_their_articles(spark):
    from daygrain.llm.queries import op6_content

    folder = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in op6_content(spark, folder).collect():
        article = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = re.split("</?(?:p|h1)>", re.sub("</?b>", "", article).replace("<br>", " "))
        assert r.text == " ".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
        assert r.n_chars == len(r.text)


RECORDS = "record_id long, url string, date long, kind string, status int, etag string, last_modified string, digest string, headers map<string,string>, last int"


def test_revisits(spark):
    h = {"ETag": '"1"', "Server": "a", "Content-Length": "9", "Vary": None}
    u = "http://www.A.org:80/x/?b=2&utm_source=q&a=1#f"
    rows = [
        (1, u, 10, "response", 200, '"1"', "d1", "s1", h), (2, "https://a.org/x?a=1&b=2", 20, "response", 404, '"9"', None, None, None),
        (3, "//a.org/x/?b=2&a=1", 30, "revisit", 304, 'W/"1"', None, None, {"Date": "30", "Server": "b", "etag": 'W/"1"'}),
        (4, u, 40, "response", 200, '"2"', None, "s2", None), (5, u, 40, "revisit", 304, '"1"', None, None, None),
        (6, u, 50, "revisit", 304, '"1"', None, None, None), (7, u, 50, "revisit", 304, None, "d1", "s2", None),
        (8, u, 50, "revisit", 304, None, "d1", None, None), (9, u, 10, "revisit", 304, '"1"', None, None, None),
        (10, None, 50, "revisit", 304, '"1"', None, None, None), (11, u, None, "revisit", 304, '"1"', None, None, None),
        (12, "http://b.org", 60, "revisit", 304, '"1"', None, None, None), (12, "http://b.org", 60, "revisit", 304, '"1"', None, None, None),
        (None, u, 60, "revisit", None, '"2"', None, None, None), (13, u, 70, None, None, None, None, None, None),
    ]
    records = spark.createDataFrame([(*r, 0) for r in rows], RECORDS)
    got = R.resolve_revisits(records, stored(spark)).collect()
    assert sorted(((r.record_id, r.response_id, r.outcome) for r in got), key=repr) == sorted(
        [
            (3, 1, "resolved"), (5, 1, "resolved"), (6, 4, "changed"), (7, 4, "resolved"), (8, 4, "unverified"), (9, None, "missing"),
            (10, None, "missing"), (11, None, "missing"), (12, None, "missing"), (12, None, "missing"), (None, 4, "resolved"),
        ], key=repr,
    )
    merged = next(r.headers for r in got if r.record_id == 3)
    assert {x.key: x.value for x in merged} == {"content-length": "9", "date": "30", "etag": 'W/"1"', "server": "a"}
    assert R.resolve_revisits(records.where("false"), stored(spark)).count() == 0


def test_hot_url_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(R, "RANGE_ROWS", 20)
    rng = random.Random(2)
    rows = [(i, rng.choice(["http://h.org/"] * 9 + ["http://g.org/"]), rng.randrange(300), rng.choice(["response", "revisit"])) for i in range(600)]
    records = spark.createDataFrame([(*r, 200, '"1"', None, None, {}, 0) for r in rows], RECORDS)
    for r in R.resolve_revisits(records, stored(spark)).collect():
        _, url, date, _ = rows[r.record_id]
        earlier = [(d, i) for i, u, d, k in rows if u == url and k == "response" and d < date]
        assert r.response_id == (max(earlier)[1] if earlier else None)
