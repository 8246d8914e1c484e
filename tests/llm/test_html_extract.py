from __future__ import annotations

import itertools
import random

import pytest

from chargestream.llm import html_extract as X

ARTICLE = ["A heading of the page", "The first paragraph has quite a few words, so that it reads as prose.", "Yes.", "Another paragraph follows & ends with more words of prose here."]
SITE = """<!DOCTYPE html><html><head><title>Not this</title><style>p{{}}</style></head><body class="page has-sidebar">
<header id="masthead"><a href="/">Site</a><p>A slogan that is long enough to look like prose to a naive reader.</p></header>
<ul class="main-menu"><li><a href=a>One</a><li><a href=b>Two</a></ul><script>document.write("<p>never this text at all, whatever it may hold</p>")</script>
<div class="cookie-notice"><p>We use cookies to make this site better for everybody who reads it.</p><button>Fine</button></div>
{article}
<div class="sidebar"><h3>Latest</h3><p>Teasers of other articles that have nothing to do with this one at all.</p></div>
<form action=x><label>Your name</label><input value="v"><textarea>typed</textarea><select><option>A<option>B</select></form>
<section id="comments"><p>I liked this article a lot, and here are many words to say so, thank you.</p></section>
<footer>&copy; Somebody</footer>"""


@pytest.mark.parametrize(
    "wrap",
    [
        '<article><h1>{0}</h1><p>{1}<div class="ad">Buy this now, it is cheap and it is good for you.</div><p>{2}</p><p>{3}</p></article>',
        "<main><h1>{0}</h1><p><b>{1}<br><p>{2}</p><p>{3}</main>",
        '<div id="content"><h2>{0}</h2><p>{1}</p><!-- <p>hidden</p> --><p>{2}</p><blockquote>{3}</blockquote></div>',
        "<div><h2>{0}</h2><p>{1}</p><p>{2}</p><p>{3}</p></div>",
    ],
)
def test_article_without_the_frame(wrap):
    html = SITE.format(article=wrap.format(*[t.replace("&", "&amp;").replace(" ", "\n  ", 1) for t in ARTICLE]))
    assert X.main_text(html) == "\n".join(ARTICLE)


PARAGRAPH = "A real paragraph of this page with a dozen words or so in it."


@pytest.mark.parametrize(
    "page",
    [
        '<div class="layout has-comments"><article><p>{}</p></article></div>',
        '<div class="site no-sidebar"><main><p>{}</p></main></div>',
        '<div class="sidebar-layout"><article><p>{}</p></article></div>',
        '<div class="post-content without-ads"><p>{}</p></div>',
        '<main><div class="widget-area-right content"><p>{}</p></div></main>',
        '<form id="page-form" action=x><article><p>{}</p></article></form>',
        '<article><section class="search-engines-compared"><p>{}</p></section></article>',
        '<article><p class="legal">{}</p></article>',
        '<article><header class="entry-header"><h1>{}</h1></header></article>',
    ],
)
def test_names_are_no_veto(page):
    assert X.main_text(page.format(PARAGRAPH)) == PARAGRAPH


@pytest.mark.parametrize(
    "page",
    [
        "<aside><article><p>{}</p></article></aside>",
        '<section id="comments"><ol><li class="comment"><article class="comment-body"><p>{}</p></article></li></ol></section>',
        '<article><form class="newsletter-form"><p>{}</p></form></article>',
        '<article><div class="ad-container"><p>{}</p></div></article>',
        '<div class="related-posts"><p>{}</p></div>',
        '<div id="footer-inner"><p>{}</p></div>',
        '<article><p hidden>{}</p></article>',
    ],
)
def test_frames_stay_out(page):
    assert X.main_text(page.format(PARAGRAPH * 10)) == ""


def test_edges_decide_what_scores_leave_open(monkeypatch):
    """One-word paragraphs amid prose stay, a longer line amid links goes; without edges it is the other way round."""
    prose = "".join(f"<p>{PARAGRAPH}</p><p>{word}</p>" for word in ("Yes.", "No.", "So?"))
    links = "".join(f'<p><a href="{i}">Word {i}</a></p>' for i in range(4))
    page = f"<div>{prose}</div><div>{links}<p>Some more links that follow here</p>{links}</div>"
    flows, cut = [], X._cut
    monkeypatch.setattr(X, "_cut", lambda nodes, *rest: flows.append(len(nodes)) or cut(nodes, *rest))
    found = X.main_text(page).split("\n")
    assert found == [PARAGRAPH, "Yes.", PARAGRAPH, "No.", PARAGRAPH, "So?"] and flows
    monkeypatch.setattr(X, "edges", lambda found: iter(()))
    assert X.main_text(page).split("\n") == [PARAGRAPH] * 3 + ["Some more links that follow here"]


def test_very_long_text():
    text = "many words " * 500_000
    assert X.main_text(f"<nav>{text}</nav><article><p>{text}</p></article>") == text.strip()


def test_unusual_pages():
    assert X.main_text(None) == X.main_text("") == X.main_text("<p> &#32; </p>") == ""
    assert X.main_text("<article><p>one &lt;b&gt; &eacute;<b>x</b>y  z") == "one <b> éxy z"
    assert X.main_text("<article><p>open <a href='x>y'>link</a> <!-- never closed") == "open link"
    assert X.main_text("<p>" * 3000 + "deep words that are many enough to be kept here" + "</p>" * 10) != ""
    long = "<article>" + "".join(f"<p>paragraph number {i} of a long page</p>" for i in range(20_000))
    assert X.main_text(long).count("\n") == 19_999


def test_labels_are_a_minimum_cut():
    rnd = random.Random(2)
    for _ in range(60):
        n = rnd.randint(1, 9)
        scores = [rnd.uniform(-2, 2) for _ in range(n)]
        joined = [(a, b, rnd.uniform(0, 2)) for a, b in itertools.combinations(range(n), 2) if rnd.random() < 0.5]

        def cost(label, scores=scores, joined=joined):
            own = sum(X._softplus(-z) if x else X._softplus(z) for x, z in zip(label, scores, strict=True))
            return own + sum(w for a, b, w in joined if label[a] != label[b])

        best = min(cost(x) for x in itertools.product((False, True), repeat=n))
        assert cost(X.label(scores, joined)) == pytest.approx(best)


def test_table(llm):
    rows = [(1, "u", None, "t"), (None, None, "<article><p>Some text</p></article>", "t"), (1, "u", None, "t")]
    found = X.extract(llm.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted(((r.page_id, r.url, r.text, r.n_chars) for r in found), key=str) == [(1, "u", "", 0), (1, "u", "", 0), (None, None, "Some text", 9)]
