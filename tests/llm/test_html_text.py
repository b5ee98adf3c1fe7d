"""Main text of pages whose article is known."""

import html
import re

import pytest

from shelfwise.llm import html_text

PAGES = "/root/testdata/sf0.001/pages.parquet"


def article(page):
    inner = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n\n".join(filter(None, blocks))


@pytest.fixture(scope="module")
def model(spark):
    return html_text.train(spark.read.parquet(PAGES))


def test_articles_come_out_whole(spark, model):
    pages = spark.read.parquet(PAGES).selectExpr("*", "1 as TEXT")
    found = html_text.extract_text(pages, model)
    assert found.columns == ["page_id", "url", "html", "text"]
    rows = found.collect()
    assert len(rows) == pages.count() and all(r.text == article(r.html) for r in rows)


def test_other_surroundings(model):
    page = """<html><body><header class="site-header"><h1>Site</h1></header><div id="cookie-notice">We use cookies. Accept.</div>
    <main><article><h1>Title &amp; more</h1><p>First   paragraph, long enough. It goes\non. And on.<br>Yes.</p><p>x</p>
    <ul><li>One thing<li>Two</ul><aside class="related">Read this too. It is nice. Really.</aside><form><label>Mail</label><input></form>
    <blockquote>Quoted <em>wo</em>rds here.</blockquote></article>
    <section class="comments"><p>Nice post! I like it. Very much. Thanks.</p></section></main>
    <div class="sidebar"><p>Sidebar text. With sentences. Many.</p></div><footer>bye</footer></body>"""
    want = ["Title & more", "First paragraph, long enough. It goes on. And on. Yes.", "x", "One thing", "Two", "Quoted words here."]
    assert html_text.extract(page, model).split("\n\n") == want


def test_pages_without_the_article_tag(spark, model):
    rows = spark.read.parquet(PAGES).collect()
    plain = [r.html.replace("<article>", "<div>").replace("</article>", "</div>") for r in rows]
    right = sum(html_text.extract(p, model) == article(r.html) for p, r in zip(plain, rows))
    assert right > 0.95 * len(rows)


@pytest.mark.parametrize(
    "page",
    ["", "<", "<p", "a < b & c", "<div" * 3000, "<b>" * 30000 + "x", "</p>" * 30000, "<!--", "<script>x", "&#0;&#x110000;&bogus;", "<p>" + "y " * 50000],
)
def test_odd_pages_do_not_crash(model, page):
    html_text.extract(page, model)


def test_marginals_are_exact(model):
    """Against the sum over all states of a small tree."""
    import itertools
    import math

    tree = html_text.parse("<body><div><p>One. Two. Three.</p><a href=x>link</a></div><nav>n</nav></body>")
    found, kinds = html_text.evidence(tree)
    n = len(found)
    total, own = 0.0, [0.0] * n
    for states in itertools.product((0, 1), repeat=n):
        weight = math.exp(sum(max(-12, min(12, sum(model.weights[f] for f in found[i]))) for i in range(n) if states[i]))
        for i in range(1, n):
            weight *= model.edges[kinds[i]][states[tree.parent[i]]][states[i]]
        total += weight
        own = [o + weight * s for o, s in zip(own, states)]
    assert html_text.marginals(tree, model) == pytest.approx([o / total for o in own], abs=1e-9)


def test_nulls_and_nothing_to_learn_from(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "<p>Some text. And more.</p>"), (3, "<p>Some text. And more.</p>")], "page_id long, html string")
    untrained = html_text.train(pages)
    assert untrained == html_text.UNTRAINED
    rows = html_text.extract_text(pages, untrained).orderBy("page_id").collect()
    assert [r.text for r in rows] == ["", "", "Some text. And more.", "Some text. And more."]
    assert html_text.extract_text(pages.where("false"), html_text.train(pages.where("false"))).count() == 0


def test_captions_and_formulas_are_kept(model):
    page = """<html><body><nav><ul><li><a href="/">Home</a></li><li><a href="/a">About</a></li></ul></nav>
    <article><h1>Title here</h1><p>First paragraph, long enough. It goes on. And on.</p>
    <p>We know that <math><mi>E</mi><mo>=</mo><mi>m</mi></math> holds here. It always does.</p>
    <figure><img src="x.png"><figcaption>A caption of the picture.</figcaption></figure>
    <p>Last paragraph, also long enough. It ends here.</p></article><footer>bye</footer></body></html>"""
    want = ["Title here", "First paragraph, long enough. It goes on. And on.", "We know that E=m holds here. It always does."]
    want += ["A caption of the picture.", "Last paragraph, also long enough. It ends here."]
    assert html_text.extract(page, model).split("\n\n") == want


A, B, C = ("One paragraph of the article. It says a good deal. And more.", "Another one, as long. It goes on. It ends.", "The last. Not short either. Done now.")


@pytest.mark.parametrize(
    "body",
    [
        f'<article class="post has-comments"><p>{A}</p><p>{B}</p><p>{C}</p></article>',
        f"<article><p title=it's>{A}</p><p>{B}</p><p>{C}</p><!-- it's --></article>",
        f'<article><p class="a"">{A}</p><p data-x="a>b" hidden = "">{B}</p><p id=p3/>{C}</p></article>',
        f"<article><section class='related-work'><p>{A}</p></section><p class='notice-board'>{B}</p><p class='login'>{C}</p></article>",
        f'<div id="page-with-sidebar"><main role="main" class="content comments-open"><p>{A}</p><p>{B}</p><p>{C}</p></main></div>',
        f"<article><noscript><p>{A}</p></noscript><svg><text>{B}</text></svg><template><p>{C}</p></template></article>",
        f'<form action="/"><div class="header-less widget-area"><article id="social-post-1"><p>{A}</p><p>{B}</p><p>{C}</p></article></div></form>',
        f'<body class="login ad-free"><article><ul class="comments-list-style"><li>{A}</li><li>{B}</li></ul><p>{C}</p></article></body>',
        f'<article class="sponsored"><h2 class="popup">{A}</h2><blockquote class="share">{B}</blockquote><p>{C}</p></article>',
    ],
)
@pytest.mark.parametrize("beside", ["", '<div class="comments"><p>Nice post! Thanks. I like it.</p></div><div class="siteFooter">About us</div>'])
def test_names_and_attributes_do_not_cost_an_article(model, body, beside):
    page = f'<html><head><title>t</title></head><body><nav><a href="/">Home</a> <a href="/x">About</a></nav>{body}{beside}<footer>bye</footer></body></html>'
    assert html_text.extract(page, model).split("\n\n") == [A, B, C]


@pytest.mark.parametrize(
    "mark", ['div class="related-links"', 'section id="comment-list"', 'p class="ad"', "div class=shareButtons", "aside", "form", 'div role="menu"']
)
def test_marked_parts_of_an_article_are_left_out(model, mark):
    name = mark.split()[0]
    page = f"<body><article><p>{A}</p><p>{B}</p><{mark}>Read this too. It is nice.</{name}><p>{C}</p></article></body>"
    assert html_text.extract(page, model).split("\n\n") == [A, B, C]
