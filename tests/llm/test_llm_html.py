"""HTML extraction: blocks against the standard library's parser, the tree against a plain walk, pages of other designs."""

import html
import random
import re
import time
from html.parser import HTMLParser

import numpy as np
import pytest

from txnguard.llm.html_extract import blocks, extract_text, features, grow, grown, labelled, main_text

TREE = grow(*labelled())


class Plain(HTMLParser):
    """Flat blocks of well-formed pages: text, words, words in links."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.found, self.text, self.linked, self.link, self.hide = [], "", "", 0, 0
        self.feed(page)
        self.close()
        self.end()

    def end(self):
        if self.text.split():
            self.found.append((" ".join(self.text.split()), len(self.text.split()), len(self.linked.split())))
        self.text = self.linked = ""

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.handle_data(" ")
        elif tag == "a":
            self.link += 1
        elif tag not in ("b", "span"):
            self.end()
        self.hide += tag in ("script", "style", "head")

    def handle_endtag(self, tag):
        self.link -= tag == "a"
        if tag not in ("b", "span", "a", "br"):
            self.end()
        self.hide -= tag in ("script", "style", "head")

    def handle_data(self, data):
        if not self.hide:
            self.text += data
            self.linked += data if self.link else ""


def random_page(rng, depth=0):
    words = ["word", "the", "&amp;", "&eacute;t&eacute;", "a &lt; b", "漢字", "&nbsp;", "x&#50;", "\n\t", "😀"]
    out = []
    for _ in range(rng.randint(1, 5)):
        kind = rng.choice(["text", "p", "div", "a", "b", "li", "br", "script", "comment", "td", "span"] if depth < 5 else ["text"])
        inner = " ".join(rng.choice(words) for _ in range(rng.randint(0, 6)))
        if kind in ("div", "li", "td"):
            out.append(f'<{kind} data-x="a>b">{random_page(rng, depth + 1)}</{kind}>')
        elif kind in ("p", "a", "b", "span"):
            out.append(f"<{kind} title='q\"'>{inner}</{kind}>")
        elif kind == "script":
            out.append('<script>if (a < b) { x = "<p>no</p>" }</script>')
        else:
            out.append({"text": inner, "br": "<br/>", "comment": f"<!-- {inner.replace('&', '')} <p> -->"}[kind])
    return "".join(out)


def test_blocks_equal_the_parsers():
    rng = random.Random(7)
    for _ in range(400):
        page = "<html><head><title>no</title></head><body>" + random_page(rng) + "</body></html>"
        assert [b[:3] for b in blocks(page)] == Plain(page).found, page


def walk(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def test_tree_splits_best_and_walks():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 6, (300, 4)).astype(float)
    y = ((x[:, 1] > 2) & (x[:, 3] <= 4)).astype(float)
    tree = grow(x, y)
    assert (grown(tree, x) >= 0.5).astype(float).tolist() == y.tolist()
    assert grown(tree, x).tolist() == [walk(tree, r) for r in x]

    def impurity(f, bound):  # by hand, over all splits
        return sum(len(p) * p.mean() * (1 - p.mean()) for p in (y[x[:, f] <= bound], y[x[:, f] > bound]) if len(p))

    best = min(impurity(f, b) for f in range(4) for b in np.arange(0.5, 5))
    assert impurity(tree[0], tree[1]) == pytest.approx(best)
    assert grow(x[:0], y[:0]) == 0.0 and grow(x, np.ones(300)) == 1.0


def test_labelled_table_is_learned():
    x, y = labelled()
    assert ((grown(TREE, x) >= 0.5) == (y > 0)).mean() > 0.98


LONG = "Long sentences with a good many words tell a reader of this page what the story is about, and they go on for a while."

DESIGNS = [
    # An article with header, byline, comments, share bar; sidebar, cookie notice, form.
    (
        f"""<body class="single no-sidebar"><header class="site"><div class=logo>The Daily</div><ul><li><a href=/>Home</a><li><a href=/x>World</a></ul></header>
        <div class="cookie-notice">We use cookies. <button>OK</button></div><main><article class="post"><header><h1>A title</h1></header><p>{LONG}<p>Short.
        <p>{LONG} <a href=y>More</a> of it.</p><ul><li>First point here</li><li>Second point here</li></ul><section id="comments"><h2>Comments</h2><p>Great piece!</p></section>
        <div class="share-bar">Share this</div></article></main><aside><p>{LONG}</p></aside><form><label>Mail</label><input name=a> Join our list</form><footer>&copy; 2020</footer>""",
        f"A title {LONG} Short. {LONG} More of it. First point here Second point here",
    ),
    # Plain divisions without any names: link density and words decide.
    (
        f"""<table><tr><td><a href=/a>Home</a></td><td><a href=/b>News</a></td><td><a href=/c>Sport</a></td></tr></table><div><h2>Of ships and sealing wax</h2><div>{LONG}</div>
        <div>{LONG} {LONG}</div><div>So it goes.</div><div>{LONG}</div></div><div><a href=/1>Other story one</a></div><div><a href=/2>Other story two</a></div>""",
        f"Of ships and sealing wax {LONG} {LONG} {LONG} So it goes. {LONG}",
    ),
    # Class names only.
    (
        f"""<div id="nav"><a href=1>One</a> <a href=2>Two</a></div><div class="ad-slot">Buy one now, get two!</div><div class="entry-content"><div class="entry-header"><h1>Title</h1></div>
        <p>{LONG}</p><div class="advertisement">{LONG}</div><p>Yes.</p><blockquote>{LONG}</blockquote></div><div class="widget">Popular</div><div id=footer>Legal text of the house</div>""",
        f"Title {LONG} Yes. {LONG}",
    ),
    ("", ""),
    ("<nav><a href=/>Home</a></nav>", ""),
]


@pytest.mark.parametrize("page,text", DESIGNS)
def test_other_designs(page, text):
    assert " ".join(main_text(page, TREE)) == text


def test_article_of_each_page(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extract_text(pages).collect()}
    for r in pages.collect():
        article = re.search("<article>(.*?)(</article>|$)", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", article))).split())
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


def test_odd_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, "<p>" + LONG), (2, "u", ""), (3, "v", "plain &amp text < 3 &#0; <b"), (4, None, "<p>" + "word " * 400_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' text", "'y' doc_id", "1 n_chars")
    got = sorted(map(tuple, extract_text(df, with_blocks=True).drop("blocks").collect()), key=str)
    text = "plain & text < 3 �"
    want = [(1, "u", "", 0), (1, "u", "", 0), (None, None, LONG, len(LONG)), (2, "u", "", 0), (3, "v", text, len(text)), (4, None, ("word " * 400_000).strip(), 1_999_999)]
    assert got == sorted(want, key=str)
    assert extract_text(df.where("false")).count() == 0


@pytest.mark.parametrize("piece", ["<", "<a ", "<p a='", "<!--", "<div>", "</div>", "&", "<script>", "<p><li>", "<a href=x>", "<b", "<p =", "<!", "</"])
def test_time_follows_the_page(piece):
    t = time.perf_counter()
    features(blocks(piece * (400_000 // len(piece))))
    assert time.perf_counter() - t < 8


def test_stray_and_unclosed_tags():
    def texts(page):
        return [b[0] for b in blocks(page)]

    assert texts("a<!-->b<!-- c > d") == ["ab"]
    assert texts("<head><title>t</title><p>x</head>y") == ["x", "y"]
    assert texts("</p>a</div></div>b<b>c</b>d") == ["a", "bcd"]
    assert texts("<script>a</scriptx></SCRIPT >b") == ["b"]
    assert texts("x<p") == ["x"] and texts("1<2 & 3>2") == ["1<2 & 3>2"]
    assert [b[2] for b in blocks("<div><a href=1>in</div><div>out</div>")] == [1, 0]
    assert [b[1:6] for b in blocks("<nav>a</nav><article>b<aside>c</aside><h2>d</h2></article>")] == [(1, 0, False, False, -1), (1, 0, False, False, 1), (1, 0, False, False, -1), (1, 0, True, False, 1)]
