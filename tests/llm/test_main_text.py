"""Main text of odd but common pages: no article is lost, and noise around it goes."""

import pytest

from moodline.llm import site_style

BODY = "A long paragraph of the article. " * 6
TEXT = " ".join(BODY.split())
PAGES = {
    "wrapper that has a sidebar": f'<body><div class="layout has-sidebar"><article><p>{BODY}</p></article><div class="sidebar">Side</div></div></body>',
    "main without a sidebar": f'<body><main class="no-sidebar"><p>{BODY}</p></main><footer>Foot</footer></body>',
    "category in the name of an article": f'<article class="category-legal"><p>{BODY}</p></article>',
    "word of noise at the end of a paragraph's name": f'<article><p class="market-share">{BODY}</p></article>',
    "data-hidden": f'<article><p data-hidden="false">{BODY}</p></article>',
    "data-class": f'<article class="post" data-class="ad"><p>{BODY}</p></article>',
    "class given twice": f'<article><div class="text" class="ad"><p>{BODY}</p></div></article>',
    "page inside one form": f'<body><form id="aspnetForm"><nav>Menu</nav><div id="page"><p>{BODY}</p></div><div class="sidebar">Side</div></form></body>',
    "article inside one form": f'<body><form id="aspnetForm"><div class="ad">Buy</div><article><p>{BODY}</p></article></form></body>',
    "text beside a teaser": f'<body><div id="content"><p>{BODY}</p></div><article><p>Teaser</p></article></body>',
    "inline noise": f'<article><p><span class="notice">New</span> {BODY}<button>Share</button></p></article>',
    "inline noise inside one form": f'<form><p>{BODY}<button>Share</button></p></form>',
    "comments longer than the article": f'<article><p>{BODY}</p></article><div id="comments"><p>{BODY * 9}</p></div>',
    "comments without an article": f'<div class="text"><p>{BODY}</p></div><ol class="comment-list"><li>{BODY * 9}</li></ol>',
    "comment inside an article": f'<article><p>{BODY}</p><article class="comment"><p>No</p></article></article>',
    "small form": f'<article><p>{BODY}</p><form><p>Your name</p></form></article>',
    "names in camel case": f'<div class="pageText"><p>{BODY}</p></div><div id="siteFooter">Foot</div>',
    "advert, notice and menu": f'<div class="ad">Buy</div><div class="cookie-notice">Cookies</div><ul class="main-menu"><li>A</li></ul><article><p>{BODY}</p></article>',
    "hidden branch": f'<article><div hidden><p>No</p></div><div style="display: none">No</div><p>{BODY}</p></article>',
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_main_text(name):
    assert site_style.main_text(PAGES[name], frozenset()) == TEXT


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, low string")


def texts(df):
    return {r["page_id"]: r["text"] for r in df.collect()}


def test_an_article_that_pages_copy_stays(spark):
    """Eight pages of a host, and one of each of five others, with one article in a named branch."""
    html = f'<body><nav>Menu</nav><article><h1>T</h1><div class="post-body"><p>{BODY}</p></div></article></body>'
    rows = [(i, f"http://one.example/{i}", html) for i in range(8)] + [(10 + i, f"http://h{i}.example/", html) for i in range(5)]
    assert set(texts(site_style.extracted(pages(spark, rows))).values()) == {f"T {TEXT}"}


def test_small_branches_that_pages_repeat_go(spark):
    rows = [(i, f"http://one.example/{i}", f'<article><p>{i} {BODY}</p><div class="box"><p>Read our house rules.</p></div></article>') for i in range(9)]
    assert texts(site_style.extracted(pages(spark, rows))) == {i: f"{i} {TEXT}" for i in range(9)}


def test_empty_pages(spark):
    rows = [(1, None, None), (2, "", ""), (3, "http://a/", "<article></article>"), (4, "http://a/", "plain"), (4, "http://a/", "plain")]
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in site_style.extracted(pages(spark, rows)).collect())
    assert got == [(1, "", 0), (2, "", 0), (3, "", 0), (4, "plain", 5), (4, "plain", 5)]
    assert site_style.extracted(pages(spark, [])).count() == 0
