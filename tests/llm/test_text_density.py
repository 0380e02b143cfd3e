import html
import re

import pytest

from foliospark.llm.common import table
from foliospark.llm.text_density import extract, main_text

BODY = "<p>A paragraph with enough words to count as running text here.</p>"


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>one<p>two<br>three<ul><li>a<li>b</ul>", "one\n\ntwo three\n\na\n\nb"),
        ("<article><h1> T\n t </h1><p>x<b>y</b> &eacute;&#33;</p></article><div>other</div>", "T t\n\nxy é!"),
        ("<nav>menu</nav><div class='ad'>buy</div><div id=c><p>main text is here, long enough</p></div><footer>f</footer>", "main text is here, long enough"),
        ("<article><p>It.</p><p>Longer text than it, by far, in this place.</p><aside>side</aside><form>f</form><div class='comments'>c</div></article>", "It.\n\nLonger text than it, by far, in this place."),
        ("<script>var t='</p><p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><p>yes</p>", "yes"),
        ("<form><h1>T</h1><p>the page is a form</p></form>", "T\n\nthe page is a form"),
        ("<div class='x'><ul><li><a href=1>Home</a><li><a href=2>News</a><li><a href=3>More</a></ul></div><div>" + BODY * 3 + "</div>", "\n\n".join([BODY[3:-4]] * 3)),
        ("<main><section>" + BODY * 2 + "</section><section><p>Short.</p>" + BODY + "</section></main>", "\n\n".join([BODY[3:-4]] * 2 + ["Short.", BODY[3:-4]])),
        ('<p title="a > b">quoted</p>', "quoted"),
        ("<p>cut <b>off", "cut off"),
    ],
)
def test_cases(page, text):
    assert main_text(page) == text


def test_given_pages_whole_articles(spark):
    def article(source):
        inner = re.search(r"<article>(.*)</article>", source, re.S)[1]
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub(r"</?(?:b|br)>", "", x))).strip() for x in re.split(r"</?(?:p|h1)>", inner))
        return "\n\n".join(x for x in blocks if x)

    pages = table(spark, "/root/testdata/sf0.01", "pages")
    sources = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in extract(pages).collect():
        assert r["text"] == article(sources[r["page_id"]]) and r["n_chars"] == len(r["text"])


def test_long_malformed_and_clashing(spark):
    rows = [(1, "<p>" + "word " * 50000, "u", "t", 5), (2, "<" * 20000, "u", "t", 5), (3, None, None, None, None), (None, "<div>" * 3000 + "deep", "u", "t", 5), (1, "<p>x", "u", "t", 5), (1, "<p>x", "u", "t", 5)]
    frame = spark.createDataFrame(rows, "page_id long, html string, url string, text string, n_chars long")
    found = extract(frame)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r["page_id"] or -1, r["n_chars"]) for r in found.collect()) == [(-1, 4), (1, 1), (1, 1), (1, 249999), (2, 20000), (3, 0)]
    assert extract(frame.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page, text",
    [
        ("<body><div>Skip to text</div><form id=f><article><h1>T</h1>" + BODY + "</article></form></body>", "T\n\n" + BODY[3:-4]),
        ("<body><div>Skip to text</div><form id=f><input type=hidden><div>" + BODY * 3 + "</div></form></body>", "\n\n".join([BODY[3:-4]] * 3)),
        ("<body><div>" + BODY * 3 + "</div><form><label>Your name</label><input><p>We keep what you enter here for as long as it takes us.</p></form></body>", "\n\n".join([BODY[3:-4]] * 3)),
        ("<body><form><label>Search</label><input></form><form><main>" + BODY + "<form><label>Name</label></form></main></form></body>", BODY[3:-4]),
    ],
)
def test_forms_by_content(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "inner, text",
    [
        ("<h2 id=discussion>Discussion</h2>", "Discussion"),
        ("<h2 id=search>Search</h2><h3 id=notifications>Notes</h3>", "Search\n\nNotes"),
        ("<section id=discussion><h2>D</h2>" + BODY + "</section>", "D\n\n" + BODY[3:-4]),
        ("<section id=forms><div class=side>" + BODY + "</div><div class=share><a href=1>Share</a></div></section>", BODY[3:-4]),
        ("<p>A <span class=alert>word</span> in it.</p><p class=related>Short.</p>", "A word in it.\n\nShort."),
        ("<div id=popular>" + BODY + "</div><div id=navigation>" + BODY + "</div>", "\n\n".join([BODY[3:-4]] * 2)),
        ("<div class=comments>c</div><ul class=related><li><a href=1>Another page with a long title that is all link</a></ul>", ""),
    ],
)
def test_names_inside_the_text(inner, text):
    start, other = BODY * 2, "<div class=sidebar>" + BODY + "</div>"
    whole = "\n\n".join(filter(None, [BODY[3:-4], BODY[3:-4], text]))
    assert main_text("<body>" + other + "<article>" + start + inner + "</article></body>") == whole
    assert main_text("<body>" + other + "<div id=c>" + start + inner + "</div><footer>f</footer></body>") == whole


OTHER = "<p>I think that this is a long enough remark to be running text.</p>"


@pytest.mark.parametrize("name", ["comments", "user-comments", "advert", "cookie-notice", "newsletter", "sidebar"])
@pytest.mark.parametrize("element", ["div", "section"])
def test_text_of_others_inside_the_article_stays_out(name, element):
    page = f"<body><article><h1>T</h1>{BODY * 2}<{element} class='{name}'>{OTHER}<article>{OTHER}</article></{element}>{BODY}</article></body>"
    assert main_text(page) == "\n\n".join(["T"] + [BODY[3:-4]] * 3)


@pytest.mark.parametrize("name", ["article-header", "page-header", "entry-header", "header"])
def test_titles_in_named_headers(name):
    assert main_text(f"<body><article><div class='{name}'><h1>The title</h1></div>{BODY}</article></body>") == "The title\n\n" + BODY[3:-4]


@pytest.mark.parametrize(
    "after",
    [f"<div class=thread>{OTHER * 12}</div>", f"<article class=reply>{OTHER * 3}</article>" * 4, f"<article class='x comment'>{OTHER}</article>" * 9, f"<div>{OTHER * 30}</div>"],
)
def test_nothing_beats_the_article(after):
    assert main_text(f"<body><article><h1>T</h1>{BODY}</article>{after}</body>") == "T\n\n" + BODY[3:-4]


def test_named_wrappers_and_teasers():
    assert main_text(f"<body><div class=sidebar>{OTHER}</div><div class='content sidebar'><article>{BODY}</article></div></body>") == BODY[3:-4]
    teaser = "<article><h3><a href=1>Another page with a long title, all of it a link</a></h3></article>"
    assert main_text(f"<body>{teaser * 3}<div id=c>{BODY * 3}</div></body>") == "\n\n".join([BODY[3:-4]] * 3)


@pytest.mark.parametrize(
    "few, many",
    [
        (f(3000), f(24000))
        for f in (
            lambda n: "<div>" * n + "x",
            lambda n: "<div>" * n + "x" + "</div>" * n,
            lambda n: "<b>" * n + "x</p>" * n,
            lambda n: "<b>" * n + "<div>x</div>" * n,
            lambda n: "<p " * n,
            lambda n: "<ul><li>" * n,
            lambda n: "x<![CDATA[>" * n,
            lambda n: "<div class=comments>" * n + BODY,
        )
    ],
)
def test_time_grows_with_the_page(few, many):
    import time

    def seconds(page):
        start = time.process_time()
        main_text(page)
        return time.process_time() - start

    assert seconds(many) < 24 * seconds(few) + 0.5  # eight times the page
