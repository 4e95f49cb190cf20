import re

import pytest
from pyspark.sql import functions as F

from strataset.llm import html, queries

SCHEMA = "page_id long, url string, html string, text string, n_chars int"
PLAIN = html.Weights({}, {})

CASES = [
    (None, ""),
    ("", ""),
    ("<html><body></body></html>", ""),
    ("just words", "just words"),
    ("<p>a<b>b</b>c&amp;d&#233;&nbsp;&lt;x&gt;</p><p>  two\n\n words</p>", "abc&dé <x> two words"),
    ("<nav><ul><li>Home</ul></nav><article><h1>Title</h1><p>One.<p>Two<br>three</article><footer>&copy; end</footer>", "Title One. Two three"),
    ("<head><title>t</title><style>p{}</style><script>var a='<p>x</p>';</script></head><body><p>body text here", "body text here"),
    ("<article><p>first part of text<div class='ad banner'>buy <div>now</div> cheap</div><p>second part</article><div id=comments><p>me too</div>", "first part of text second part"),
    ("<article><header><h1>Head</h1></header>words of text<!-- <p>hidden --> more<aside>side</aside></article>", "Head words of text more"),
    ("<div class=cookieNotice>accept</div><main><p>text<form>mail <input></form></main><div style='display: none'>x</div>", "text"),
    ("<p title='a > b'>quoted attribute</p>", "quoted attribute"),
    ("<p>unclosed <a href=\"x>link</p><p>next", None),
    ("<p>" * 3000 + "deep", "deep"),
    ("<b>" * 50_000, ""),
    ("<" * 50_000, None),
    ("<p>" + "word " * 200_000, "word " * 199_999 + "word"),
]


@pytest.mark.parametrize("k", range(len(CASES)))
def test_cases(k):
    page, want = CASES[k]
    got = html.main_text(page, PLAIN)
    if want is not None:
        assert got == want


def test_best_region_equals_search():
    import numpy as np

    rng = np.random.default_rng(0)
    for _ in range(100):
        x = rng.integers(-5, 6, 12).astype(float)
        a, b = html.best_region(x)
        sums = [x[i:j].sum() for i in range(12) for j in range(i + 1, 13)]
        assert x[a:b].sum() == max([0.0, *sums])


def test_learned_weights_and_all_rows(spark):
    pages = spark.createDataFrame([(i, "u", p, "clash", 1) for i, (p, _) in enumerate(CASES)] + [(None, None, CASES[5][0], "", 1)] * 2, SCHEMA)
    sample = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    weights = html.fit(sample)
    assert weights.word((html.Element("body", ("body",), False, False), html.Element("article", ("article",), False, True))) > 0
    rows = html.extract(pages, weights).collect()
    assert len(rows) == len(CASES) + 2
    assert all(r.n_chars == len(r.text) for r in rows)
    assert {r.text for r in rows if r.page_id in (None, 5)} == {"Title One. Two three"}
    assert html.fit(pages.limit(0)) == html.Weights({}, {})
    assert html.extract(pages.limit(0), weights).collect() == []


def test_articles_of_the_table(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.QUERIES["op1_html_extraction"](spark, sf).select("page_id", "text", "n_chars")
    rows = found.join(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html"), "page_id").collect()
    from html import unescape

    right = 0
    for r in rows:
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        inline = re.sub(r"</?b>", "", body)
        want = " ".join(unescape(re.sub(r"<[a-zA-Z/][^>]*>", "\n", inline)).split())
        right += want == r.text
    assert right == len(rows)


NO_MARKS = [
    'href="/the-hidden-city"', 'title="Hidden gems"', "title='a hidden b'", 'data-hidden="false"', 'href="/story?id=search"',
    "href=/story?class=sidebar", 'data-class="comments"', 'data-x="role=navigation style=display:none"', 'alt = "id=footer"',
]


@pytest.mark.parametrize("attribute", NO_MARKS)
def test_words_in_values_of_other_attributes_mark_nothing(attribute):
    page = f"<article {attribute}><p>some <a {attribute}>linked</a> words</p></article>"
    assert html.main_text(page, PLAIN) == "some linked words"


@pytest.mark.parametrize("attribute", ["hidden", "HIDDEN=''", 'href="/x" hidden', "id = 'search'", "title=x class=sidebar", 'style="display: none"'])
def test_own_attributes_still_mark(attribute):
    assert html.main_text(f"<p>some words</p><div {attribute}>others</div>", PLAIN) == "some words"


WRAPPERS = ["<div class='layout has-sidebar'>", "<div class=with-header>", "<div id=page class='has-comments'>", "<div class=search-page>", '<form id="aspnetForm">']
ASIDES = "<div class=sidebar>side words</div><div class=comments><article>a comment</article><p>me too</div><nav>menu</nav>"


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("outer", ["", "<main>", "<div class='page no-sidebar'>"])
def test_wrappers_of_an_article_do_not_hide_it(wrapper, outer):
    end = "</form>" if "form" in wrapper else "</div>"
    page = f"<body><div class=masthead>logo</div>{outer}{wrapper}<article><h1>Title</h1><p>some <span class=ad>buy</span></p><p>words of it</article>{ASIDES}{end}"
    assert "Title some" in html.main_text(page, PLAIN) and html.main_text(page, PLAIN).endswith("words of it")
    assert not {"side", "comment", "menu", "logo"} & set(html.main_text(page, PLAIN).split())
    inside = [n for kind, mark, inside, n in html._labelled(page.replace("<article>a comment</article>", "")) if kind == "word" and not mark and inside]
    assert sum(inside) >= 5


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_wrappers_of_a_page_without_an_article(wrapper):
    words = " ".join(f"w{i}" for i in range(40))
    page = f"<body><a>skip this</a>{wrapper}<div class=post><p>{words}</p></div>{ASIDES.replace('article', 'div')}"
    assert html.main_text(page, PLAIN).endswith(words)


def test_asides_that_hold_articles_stay_out():
    page = "<main><p>the text of this page</p><div class=related><article>a teaser</article></div></main>"
    assert html.main_text(page, PLAIN) == "the text of this page"
    page = "<article>short text</article><div class=comments>" + "<p>a long comment" * 50 + "</div>"
    assert html.main_text(page, PLAIN) == "short text"
    assert html.main_text("<div class=cookies>accept all</div>", PLAIN) == ""
    assert html.main_text("<div hidden><article>unseen</article></div>", PLAIN) == ""


@pytest.mark.parametrize(
    "page",
    [
        '<p>one <svg class="icon"/> two</p><p>three</p>',
        '<p>one <svg class="icon" /> two</p><svg><path d="x"/><title>icon</title></svg><p>three</p>',
        "<p>one <noscript>two</p><p>three</p>",
        "<title>a title<p>one two</p><p>three</p>",
        "<title>a title</title><p>one two</p><p>three</p>",
        "<noscript><p>turn it on</p></noscript><p>one two <svg><text>a</text></svg></p><template><p>x</p></template><p>three</p>",
        "<p>one two</p><svg><path><p>three</p><svg/><svg></svg>",
    ],
)
def test_drawings_and_unclosed_elements_swallow_nothing(page):
    assert html.main_text(page, PLAIN) == "one two three"


@pytest.mark.parametrize(
    "part",
    ["<h2 id='related-work'>{}</h2>", "<h2 id='sharing-data'>{}</h2>", "<section id='notice-of-default'>{}</section>",
     "<div class='social-history'>{}</div>", "<p id='form-of-verbs'>{}</p>", "<h2 class='search'>{}</h2>",
     "<div class='a b c d e f g h related-work'>{}</div>", "<div class='adHoc'>{}</div>"],
)
def test_names_with_other_words_mark_nothing(part):
    page = f"<article><p>before it</p>{part.format('the words')}<p>after it</p></article>"
    assert html.main_text(page, PLAIN) == "before it the words after it"
    assert html.main_text(f"<h1 id='search-for-truth'>A title</h1><p>some words</p>{part.format('more')}", PLAIN) == "A title some words more"


@pytest.mark.parametrize("name", ["cookie-banner", "sidebar_left", "siteFooter", "post-comments", "ad-300", "a b c d e f g h i sidebar"])
def test_names_of_asides_as_a_whole_mark(name):
    assert html.main_text(f"<article><p>some words</p><div class='{name}'>others</div></article>", PLAIN) == "some words"


@pytest.mark.parametrize("n", [1, 24, 25, 400])
def test_no_number_of_words_decides(n):
    words = " ".join(f"w{i}" for i in range(n))
    assert html.main_text(f"<div class='has-sidebar'><p>{words}</p></div>", PLAIN) == words
    assert html.main_text(f"<form id=aspnetForm><p>{words}</p></form>", PLAIN) == words
    assert html.main_text(f"<div class='sidebar'><p>{words}</p></div>", PLAIN) == ""
