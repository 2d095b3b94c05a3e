"""Main text extraction: templates, votes and odd pages."""

import re

import pytest
from pyspark.sql import functions as F

from signalbox.llm import html_consensus as H
from signalbox.llm.ship import ship

SMALL = "/root/testdata/sf0.01"
PAGE = "page_id long, url string, html string"


def brute(page):
    """For the one template of the given tables: the article's paragraphs and headings."""
    import html
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1|ul|ol|li|div|h2|h3|blockquote|table|tr|td|pre)\b[^>]*>", re.sub(r"<!--.*?-->", "", body, flags=re.S))
    clean = [" ".join(html.unescape(re.sub(r"<[^>]+>", lambda m: " " if m[0].startswith("<br") else "", b)).split()) for b in blocks]
    return "\n\n".join(b for b in clean if b)


def test_given_pages(spark):
    ship(spark)
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    got = {r.page_id: r for r in H.main_texts(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.page_id].text == brute(r.html) and got[r.page_id].n_chars == len(got[r.page_id].text)


PARAS = ["First paragraph of the story, long enough to count as its own block.", "Second &amp; last: it&#8217;s  got\n white&nbsp;space and a <b>bold</b> word."]
WANT = "A title\n\n" + PARAS[0] + "\n\nSecond & last: it’s got white space and a bold word."
BODY = "<h1>A title</h1>" + "".join(f"<p>{p}</p>" for p in PARAS)


@pytest.mark.parametrize("page", [
    f"<html><body><nav><a href=/>Home</a></nav><main>{BODY}</main><footer>&copy; x</footer></body></html>",
    f"<body><div id='top-nav'><ul><li>Menu</li></ul></div><div class=content-12>{BODY}</div><div class='sidebar right'><p>Side words.</p></div></body>",
    f"<div class=\"page\"><header><h2>Site</h2></header><div class='post-body'>{BODY}<div class=comments><p>Nice!</p></div></div></div>",
    f"<ARTICLE CLASS=x><HEADER><H1>A title</H1></HEADER><P>{PARAS[0]}<P>{PARAS[1]}<ASIDE><P>By the way</ASIDE></ARTICLE>",
    f"<article>{BODY}<form><p>Sign up</p><input value='a>b'></form><script>if (a<b) x('</p><p>no</p>')</script></article><div class=cookie-notice><p>{'Cookies. ' * 30}</p></div>",
    f"<!-- <article><p>no</p></article> --><body><section class='ad-slot'><p>Buy</p></section>{BODY}</body>",
    f"<article><div role=navigation><p>Skip</p></div>{BODY}<style>p{{}}</style><section id=comments><p>Reader comment</p></section></article>",
    f"<article><a title=\"x > y\" class='nav-link'></a>{BODY}<unclosed attr='",
])
def test_templates(page):
    assert H.extract(page, None) == WANT


@pytest.mark.parametrize("page", [
    f"<body><div class='layout has-sidebar'><div class='sidebar'><p>Side words.</p></div><div class=content>{BODY}</div></div></body>",
    f"<body><div class='container no-ads'><article>{BODY}</article></div><div class=ads><p>Buy</p></div></body>",
    f"<body><section class='post widget-body'>{BODY}<div class='related-posts'><article><p>More</p></article></div></section></body>",
    f"<body><div id='content-with-menu'><ul class=menu><li>Home</li></ul>{BODY}</div></body>",
    f"<body><form id=aspnetForm><div class='menu'><p>Home</p></div><main>{BODY}</main><select><option>x</select></form></body>",
    f"<body><form>{BODY}</form></body>", f"<div class='modal'>{BODY}</div>", f"<div class='share comments'>{BODY}</div>",
    f"<article>{BODY}</article><div class='comment-list'>{'<p>A long reader comment on this story.</p>' * 20}</div>",
    f"<article>{BODY}</article><div class='sidebar'>{'<p>A long teaser of another story.</p>' * 20}</div>",
])
def test_names_of_wrappers_do_not_drop_the_article(page):
    assert H.extract(page, None) == WANT


@pytest.mark.parametrize("page, want", [
    # headline and lead outside the container that wins
    (f"<body><div class=page><h1>A title</h1><div class=content>{BODY.replace('<h1>A title</h1>', '')}</div></div></body>", WANT),
    (f"<body><h1>A title</h1><div class=content>{BODY.replace('<h1>A title</h1>', '')}</div><div class=end>Some words</div></body>", WANT),
    (f"<body><div class=page><div class=lead><p>The lead.</p></div><div class=text>{BODY}</div></div></body>", "The lead.\n\n" + WANT),
    (f"<body><article><h1>A title</h1><p>A lead.</p><div class=body>{BODY.replace('<h1>A title</h1>', '')}</div></article></body>",
     WANT.replace("A title\n\n", "A title\n\nA lead.\n\n")),
    # but no list of links, and nothing as large as the article
    (f"<body><div class=page><div class=top><a href=/>One</a> <a href=/>Two</a></div><div class=content>{BODY}</div></div></body>", WANT),
    (f"<body><div class=page><div class=loud>{'<p>Loud words.</p>' * 20}</div><div class='post-content'>{BODY * 2}</div></div></body>", None),
    # a formula or a medium inside a line keeps the line together
    (f"<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be it.</p>{BODY}</article>", "Let x=2 be it.\n\n" + WANT),
    (f"<article><p>See <object data=x>the plan</object> and <video src=y>the film</video>.</p>{BODY}</article>", "See the plan and the film.\n\n" + WANT),
])
def test_what_stands_beside_the_container(page, want):
    got = H.extract(page, None)
    assert got == want if want else "A title" in got


def test_consensus_overrules_a_page(spark):
    ship(spark)
    noise = "<div class='promo-free'><p>" + "Loud words everywhere. " * 40 + "</p></div>"
    page = lambda i, extra="": f"<body><div class='c{i}'><p>Text {i} of this page, some words long.</p></div>{extra}</body>"
    rows = [(i, "https://x.example.org/a", page(i)) for i in range(20)]
    rows += [(99, "https://X.example.org/b", page(99, noise.replace("promo-free", "loud"))), (100, "https://other.example.org", page(5, noise.replace("promo-free", "loud")))]
    got = {r.page_id: r.text for r in H.main_texts(spark.createDataFrame(rows, PAGE)).collect()}
    assert got[99] == "Text 99 of this page, some words long."
    assert got[100].startswith("Loud words") or "Loud words" in got[100]
    won = H.host_paths(spark.createDataFrame(rows, PAGE)).where("host = 'x.example.org'").first()
    assert won.path.endswith("div.c")


def test_pages_of_a_minority_template_keep_their_article(spark):
    ship(spark)
    page = lambda i: f"<body><div class='content'><p>Text {i} of this page, some words long.</p><p>And some more of them.</p></div></body>"
    other = lambda i: f"<body><div class='content'><p>A teaser.</p></div><div class='story'><p>{f'Story {i} in full. ' * 20}</p></div></body>"
    rows = [(i, "https://x.example.org/a", page(i)) for i in range(20)] + [(100, "https://y.example.org/", other(100))]
    rows += [(i, "https://x.example.org/b", other(i)) for i in range(100, 103)]
    rows += [(200 + i, "https://z.example.org/", page(i)) for i in range(20)] + [(300, "https://z.example.org/", other(300))]
    got = {r.page_id: r.text for r in H.main_texts(spark.createDataFrame(rows, PAGE)).collect()}
    assert H.host_paths(spark.createDataFrame(rows, PAGE)).where("path like '%content'").count() == 2
    for i in (*range(100, 103), 300):
        assert f"Story {i} in full." in got[i], i
    assert all("And some more" in got[i] for i in (*range(20), *range(200, 220)))


def test_odd_rows(spark):
    ship(spark)
    rows = [(1, None, None), (1, None, None), (2, "not a url", ""), (None, "https://a.b/", "plain text & <b>more</b>"), (4, "https://a.b/", "<p>"),
            (5, "https://a.b/", "<p>" + "word " * 100000 + "</p>"), (6, "https://a.b/", "<" * 20000), (7, "https://a.b/", "<a '" * 5000), (8, "https://a.b/", "<div>" * 3000 + "x")]
    df = spark.createDataFrame(rows, PAGE).withColumns({c: F.lit("c") for c in ("host", "path", "text", "n_chars", "vote")})
    got = [(r.page_id, r.n_chars) for r in H.main_texts(df).collect()]
    by = dict(got)
    assert len(got) == len(rows) and by[1] == 0 and by[2] == 0 and by[None] == len("plain text & more") and by[5] == 499999 and by[8] == 1
    assert H.main_texts(df.where("false")).count() == 0
