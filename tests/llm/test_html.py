"""Main text: messages against brute force, marked pages, unmarked layouts, broken markup."""

from __future__ import annotations

import html
import itertools
import re
import time

import pytest

from contrail.llm import html_text as H
from contrail.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
MODEL = H.Model({})


def brute(model, page):
    """Marginals by summing over every assignment of states."""
    n = len(page.parent)
    total = [[0.0] * 3 for _ in range(n)]
    for states in itertools.product(range(3), repeat=n):
        p = H.START[states[0]]
        for i, s in enumerate(states):
            for key in page.evidence[i]:
                p *= model.likely[key][s]
            if i:
                p *= model.move[page.edge(i)][states[page.parent[i]]][s]
        for i, s in enumerate(states):
            total[i][s] += p
    return [[x / sum(row) for x in row] for row in total]


@pytest.mark.parametrize("source", ["<div><p>one two</p><ul class=menu><li><a>x</a></ul></div>",
                                    "<article><p>a b c d.</p><aside>q</aside></article><footer>f</footer>"])
def test_messages_equal_brute_force(source):
    page = H.Page(source)
    for got, want in zip(MODEL.marginals(page), brute(MODEL, page), strict=True):
        assert got == pytest.approx(want, abs=1e-9)


def article(source):
    """The article's blocks by a plain rule that fits the test pages."""
    inner = re.search(r"<article>(.*?)</article>", source, re.S).group(1)
    blocks = re.split(r"</?(?:p|h1)>", inner)
    texts = (" ".join(html.unescape(re.sub(r"<[^>]+>", lambda m: " " if m.group() == "<br>" else "", b)).split())
             for b in blocks)
    return "\n\n".join(t for t in texts if t)


def test_query_against_plain_rule(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    out = QUERIES["op10_tree_model_main_text"](spark, SMALL).collect()
    assert len(out) == len(pages)
    assert [r.page_id for r in out if r.text != article(pages[r.page_id]) or r.n_chars != len(r.text)] == []


TEXT = "It was a long day and the river had risen over the fields again, so nobody crossed the bridge before noon. "


def test_layouts_without_article():
    source = f"""<html><head><title>T</title></head><body><div class="cookie-notice">We use cookies.</div>
    <header><a href=/>Home</a></header><div id="menu"><ul><li><a href=a>News</a><li><a href=b>Sport</a></ul></div>
    <div class="wrap"><div class="content"><h1>The river</h1><p>{TEXT * 2}</p><p>{TEXT}&amp; more.<br>End.</p>
    <div class="ad">Buy now</div></div><div class="sidebar"><ul><li><a href=x>Other story</a></ul></div></div>
    <section id="comments"><h2>Comments</h2><article class="comment"><p>{TEXT}</p></article></section>
    <form><label>Name</label><input><button>Go</button></form><footer>&copy; 2020 x</footer></body></html>"""
    assert MODEL.extract(source).split("\n\n") == ["The river", (TEXT * 2).strip(), TEXT + "& more. End."]


@pytest.mark.parametrize("source", ["", None, "<", "<!--", "<a href='", "</p></p>", "<script>x", "<p" * 50, "<div>" * 3000,
                                    "&#xZZ;&bogus;", "<article><p>a", "\x00<p>\x00"])
def test_broken_markup(source):
    assert isinstance(MODEL.extract(source), str)


def test_script_text_and_entities():
    assert MODEL.extract(f'<article><script>var t="</p>";</script><p>{TEXT}&lt;b&gt; &#233;&nbsp; x</p></article>') \
        == TEXT + "<b> é x"


def test_edge_rows(spark):
    rows = [(1, "u", None, "t"), (None, None, "", "t"), (2, "u", f"<article><p>{TEXT}</article>", None)]
    pages = spark.createDataFrame(rows * 2, "page_id long, url string, html string, text string")
    out = H.extract_pages(pages, H.train(pages)).collect()
    assert sorted((r.n_chars for r in out)) == [0, 0, 0, 0, len(TEXT) - 1, len(TEXT) - 1]
    assert H.extract_pages(pages.limit(0), H.train(pages.limit(0))).count() == 0


def test_boilerplate_inside_and_after_the_article():
    inner = f"""<h1>Title</h1><p>{TEXT}</p><p>Short.</p><ul><li>one</li><li><a href=1>two</a></li></ul><div class="ad">Buy</div>
    <form><label>Mail</label></form><aside><p>{TEXT}</p><p>{TEXT}</p></aside><div class="share"><a href=1>Tweet</a></div>
    <section class="comments"><h3>Comments</h3><p>{TEXT}</p><p>{TEXT}</p><p>nice</p></section>"""
    after = f'<div id="comments"><p>{TEXT * 2}</p><p>{TEXT}</p></div><div class="cookie">{TEXT}</div>'
    pages = [f"<body><nav><a href=x>Home</a></nav><article>{inner}</article>{after}<footer>c</footer></body>"] * 2
    for model in (MODEL, H.Model(sum((H.page_counts(p) for p in pages), H.Counter()))):
        assert model.extract(pages[0]).split("\n\n") == ["Title", TEXT.strip(), "Short.", "one", "two"]


def test_a_page_inside_one_form():
    source = f"<body><form><div><h1>Title</h1><p>{TEXT}</p><p>{TEXT}</p><p>{TEXT}</p><p>{TEXT}</p></div></form></body>"
    assert MODEL.extract(source).count(TEXT.strip()) == 4


@pytest.mark.parametrize("start", ["<head><title>x</title>", "<head><script>a('<div>')</script><noscript><img></noscript><title>x</title>",
                                   "<head><meta charset=a><link href=b>", "<head><title>x</title></head><body>"])
def test_head_ends_at_the_first_tag_that_cannot_stand_in_it(start):
    assert MODEL.extract(f"{start}<article><p>{TEXT}</p></article>") == TEXT.strip()


@pytest.mark.parametrize("tag", ["button", "iframe", "select", "object", "noscript"])
def test_unclosed_elements_drop_only_what_is_theirs(tag):
    for source in (f"<article><div><{tag}>Menu</div><p>{TEXT}</p></article>", f"<article><{tag}>Menu<p>{TEXT}</p></article>",
                   f"<article><{tag}>Menu<p>{TEXT}</p><{tag}>More</{tag}></article>"):
        assert MODEL.extract(source) == TEXT.strip()
    assert MODEL.extract(f"<article><{tag}><p>Menu</p></{tag}><p>{TEXT}</p></article>") == TEXT.strip()


def test_math_is_text():
    assert MODEL.extract(f"<article><p>{TEXT}So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> here.</p></article>") \
        == TEXT + "So x=2 here."


@pytest.mark.parametrize("opened", ['section id="related-work"', 'div class="legal-analysis"', 'p class="share-price"',
                                    'div class="side-effects"', 'section class="searchEngineHistory"'])
def test_everyday_words_in_class_names_drop_nothing(opened):
    tag = opened.split()[0]
    source = f"<article><h1>Title</h1><p>{TEXT}</p><{opened}>{TEXT}</{tag}><p>{TEXT}</p></article>"
    for model in (MODEL, H.Model(H.page_counts(source))):
        assert model.extract(source).count(TEXT.strip()) == 3


@pytest.mark.parametrize("name", ["related-posts", "share-buttons", "cookie-notice", "comment-list", "social_icons", "side-bar",
                                  "legalNotice", "search-results", "newsletter-signup", "ad-slot", "site-footer", "share"])
def test_boilerplate_named_by_compounds_is_dropped(name):
    source = f'<article><p>{TEXT}</p><div class="{name}"><p>{TEXT * 2}</p></div><p>{TEXT}</p></article>'
    assert MODEL.extract(source).split("\n\n") == [TEXT.strip()] * 2


@pytest.mark.parametrize("part", ["<div></p></b></li>", "<noscript>", "<b></i>", "<li><div>", "<dt></dt><div>", "<button>x</div>",
                                  "<a href='", "<td></tr>", "<head><title>"])
def test_time_is_linear_in_long_broken_pages(part):
    """A page of four times the length takes four times as long (sixteen times, were it quadratic)."""
    def seconds(n):
        source = f"<head>{part * n}<div><dl><dt><ul>{part * n}</ul>{'</span></div>' * n}"
        began = time.process_time()
        MODEL.extract(source)
        return time.process_time() - began
    seconds(500)
    assert seconds(24000) < 9 * seconds(6000) + 0.5


def test_copies_of_a_page_are_learned_once(spark):
    first, other = f"<article><p>{TEXT}</p></article>", f"<main><h1>T</h1><p>{TEXT}</p></main><nav>x</nav>"
    once = H.train(spark.createDataFrame([(first,), (other,)], "html string"))
    often = H.train(spark.createDataFrame([(first,)] * 500 + [(other,)], "html string"))
    assert once.likely == often.likely and once.move == often.move
