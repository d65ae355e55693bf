import html
import re
import time

import pytest
from llm.odd import table

from carelake.llm.html_main import extract_pages, main_text

ARTICLE = "<p>" + "A paragraph of the article with enough words to stand out. " * 3 + "</p>"
BODY = "A paragraph of the article with enough words to stand out. A paragraph of the article with enough words to stand out. A paragraph of the article with enough words to stand out."


def test_pages_of_the_table(spark):
    pages = table(spark, "pages")
    for page, row in zip(pages.orderBy("page_id").collect(), extract_pages(pages).orderBy("page_id").collect(), strict=True):
        inner = re.search(r"<article>(.*)</article>", page.html, re.S)[1]
        blocks = re.sub(r"<[^>]+>", "", re.sub(r"<br>", " ", re.sub(r"</?(?:p|h1)>", "\0", inner))).split("\0")
        want = "\n\n".join(b for b in (" ".join(html.unescape(x).split()) for x in blocks) if b)
        assert (row.url, row.text, row.n_chars) == (page.url, want, len(want))


def test_what_is_not_the_article_goes():
    page = f"""<!doctype html><html><head><title>T</title><style>p{{}}</style><script>if (a < b) document.write("<p>no</p>")</script></head>
    <body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=x>Menu</a></ul></nav><div class="cookie-notice">We use cookies on this site, and more.</div>
    <main><article><header><h1>Title &amp; more</h1><p class=byline>by someone</p></header>{ARTICLE}
    <div class="ad">Buy this thing now, it is really very good and cheap for you.</div><p>Short.</p><aside>Related things</aside>
    <form><p>Your mail</p><input name=a><button>Send</button></form><ul><li>First &eacute;<li>Second</ul><p>Unclosed <b>bold<p>Last
    line<br>goes on &#8212; here</article></main><section id="comments"><article class="comment"><p>{'Nice text, I liked it very much. ' * 5}</p></article></section>
    <aside class=sidebar><p>{'Side words of a longer kind. ' * 9}</p></aside><footer><p>&copy; all rights</p></footer><script>x</script>"""
    assert main_text(page) == "\n\n".join(["Title & more", BODY, "Short.", "First é", "Second", "Unclosed bold", "Last line goes on — here"])


def test_pages_without_marks_use_the_distribution():
    page = f"""<body><div><a href=1>Home</a></div><div><a href=2>News</a></div><div><a href=3>About us</a></div><div>Login</div><hr><hr>
    <div><h1>A heading</h1>{ARTICLE}{ARTICLE}<p>Tiny.</p>{ARTICLE}</div>
    <div><a href=4>Older</a></div><div><a href=5>Newer</a></div><div><a href=6>Top</a></div><div>(c) 2020</div></body>"""
    assert main_text(page) == "\n\n".join(["A heading", BODY, BODY, "Tiny.", BODY])
    assert "Older" not in main_text(page) and "Home" not in main_text(page) and "2020" not in main_text(page)


def test_odd_input(spark):
    assert main_text(None) == main_text("") == main_text("<nav>a</nav>") == main_text("<!-- only") == ""
    assert main_text("just text") == "just text"
    assert main_text("<article><p a='>'>x</p><script>never closed <p>y") == "x"
    assert main_text("<article>a &lt;b&gt; &amp;amp; c</article>") == "a <b> &amp; c"
    assert main_text("<article><nav>menu<p>more menu</nav>x</article>") == "x"
    long = "<article>" + "<div>" * 3000 + "deep" + "<p>w</p>" * 20_000
    assert main_text(long).count("w") == 20_000
    rows = [(1, None, None, 1), (1, None, None, 1), (None, "u", "<main>m</main>", 2), (2, "v", "", 3)]
    got = extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, None, "", 0), (1, None, "", 0), (None, "u", "m", 1), (2, "v", "", 0)], key=repr)
    assert extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_names_that_only_resemble_boilerplate():
    assert main_text('<div class="entry-content share-enabled"><p>text</p></div>') == "text"
    assert main_text('<div id=content><p>text</p><div class="comment content"><p>mine</p></div></div>') == "text"
    assert main_text('<article><p>text</p><div class="post-share"><p>tell all</p></div><span class="ad">buy</span></article>') == "text"


PAGES = {
    "head without end tag": f"<html><head><title>T</title><meta charset=utf-8><body><article>{ARTICLE}</article></body></html>",
    "head without end tag and no body": f"<html><head><title>T</title><article>{ARTICLE}</article>",
    "form around the page": f"<body><form action=x><nav>Menu</nav><div><article>{ARTICLE}</article></div><footer>(c)</footer></form></body>",
    "form without an article": f"<body><form action=x><nav>Menu</nav><div>{ARTICLE}</div><footer>(c)</footer></form></body>",
    "sidebar-right": f"<body><div class='wrapper sidebar-right'><article>{ARTICLE}</article></div><p>{'Other words of this page. ' * 20}</p></body>",
    "widgets": f"<main><h2 class=sidebar-title>x</h2><div class='elementor-widget elementor-widget-post'><article>{ARTICLE}</article></div></main>",
    "widgets in an article": f"<article><div class='elementor-widget a'>{ARTICLE}</div><div class='elementor-widget nav-menu'>Menu</div></article>",
    "header-fixed": f"<body><div class='page header-fixed'><header><p>Site</p></header><article>{ARTICLE}</article></div></body>",
    "only a sidebar": f"<body><div class=sidebar>{ARTICLE}</div></body>",
    "cards": f"<article>{ARTICLE}</article><aside><article><p>A card.</p></article><article><p>One more card.</p></article></aside>",
    "comments": f"<article>{ARTICLE}</article><section id=comments><article class=comment>{'<p>I liked this very much indeed.</p>' * 99}</article></section>",
}


def test_marks_around_the_article():
    got = {name: main_text(page) for name, page in PAGES.items()}
    assert got == {name: BODY for name in PAGES}


def test_formulas_stay():
    page = "<article><p>so <math><semantics><msup><mi>x</mi><mn>2</mn></msup><annotation encoding=tex>x^2</annotation></semantics></math> grows</p></article>"
    assert main_text(page) == "so x2 grows"


def test_login_above_an_unmarked_article_goes():
    page = f"""<body><div><a href=1>Home</a></div><div><a href=2>News</a></div><div><a href=3>About us</a></div><div>Login</div><hr><hr>
    <div><h1>A heading</h1>{ARTICLE}{ARTICLE}<p>Tiny.</p>{ARTICLE}</div></body>"""
    assert main_text(page) == "\n\n".join(["A heading", BODY, BODY, "Tiny.", BODY])


ENDLESS = ['<a b="', "<a b='", "<a b=\"'", "<a ", "</i", "</script", "<!--", "<! ", "<b c=d>", "a= ", "&", "="]


@pytest.mark.parametrize("piece", ENDLESS)
def test_long_broken_pages_take_linear_time(piece):
    for page in (piece * (2_000_000 // len(piece)), piece * (2_000_000 // len(piece)) + ">", "<script>" + piece * (2_000_000 // len(piece)) + ">"):
        began = time.process_time()
        assert isinstance(main_text(page), str)
        assert time.process_time() - began < 8


def test_end_tags_without_start_take_linear_time():
    for page in ("<b c=d>" * 180_000 + "</i>" * 180_000, "<p><td>" + "<b c=d>" * 180_000 + "</p>" * 180_000):
        began = time.process_time()
        assert main_text(page) == ""
        assert time.process_time() - began < 10


def test_unclosed_quotes_keep_what_follows():
    assert main_text('<article><p class="x>one</p><p>two</p></article>') == "one\n\ntwo"
    assert main_text('<article><p title="a > b">one</p> 1 < 2 <3 <article') == "one\n\n1 < 2 <3 <article"
    assert main_text("<article>a<!-- <p>b</p> --->c<!-- never closed <p>d</p>") == "ac"
