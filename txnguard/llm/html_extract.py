"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into flat blocks: the text between two block-level tags. What is known
of a block is shallow: how many words it has, what share of them are links, the same
of its neighbours, whether it is a heading or a list item, and whether the nearest
ancestor that says something about its part of the page (an element such as ``nav`` or
``article``, or such a word in its class or id) calls it content or surroundings. A
decision tree, grown here from a small table of labelled blocks, says of each block
whether it's main text. Each page is one row's work; nothing is shuffled.
"""

from __future__ import annotations

import html
import re

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from txnguard.llm.common import arrow_schema, batch_of, text_batches

# Elements of HTML by what they mean for a text block.
UNSEEN = frozenset("head script style noscript template iframe object svg math canvas textarea select option button title noembed noframes xmp audio video datalist".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())  # markup inside isn't parsed
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output progress q rp rt ruby s samp small span strike strong sub sup time tt u var"
    " wbr img br input".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SURROUNDING = frozenset("nav footer aside form menu dialog fieldset".split())
SAME_ENDS = frozenset("li dt dd td th option".split())  # a new one ends the one before
IN_HEAD = frozenset("title meta link script style base noscript template".split())
# Words of class and id attributes: how they begin, or whole.
SURROUNDING_STEMS = (
    "advert", "breadcrumb", "comment", "cookie", "copyright", "disclaimer", "discuss", "disqus", "footer", "masthead", "navbar", "navig", "newsletter", "paginat", "popup", "promo",
    "recommend", "related", "share", "sharing", "sidebar", "sponsor", "subscri", "topbar", "widget",
)
SURROUNDING_WORDS = frozenset(
    "ad ads alert banner consent dialog foot gdpr legal login menu menubar modal nav notice notices overlay pager replies reply search side signup skip social tagcloud tags teaser toc toolbar".split()
)
HEADERS = frozenset("header head".split())
MAIN_WORDS = frozenset("article articlebody body content entry main maintext post story text".split())
NEGATING = frozenset("has no with without".split())  # "with-sidebar" isn't one

#: A start or end tag: slash, name, attributes. Quotes count only after an equals sign.
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?|[^>=])*+)>""")
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|style|hidden|aria-hidden)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"']++))?(?=[\s/"']|$)""", re.I)
WORDS = re.compile(r"[a-z]+")


def named(value: str, inside: int) -> int:
    """What a class, id or role says: 1 main text, -1 surroundings, 0 nothing."""
    said = 0
    for token in value.split():
        words = WORDS.findall(token)
        if NEGATING.intersection(words):
            continue
        if any(w in SURROUNDING_WORDS or w.startswith(SURROUNDING_STEMS) for w in words):
            return -1
        if MAIN_WORDS.intersection(words):
            said = said or int(not HEADERS.intersection(words))
        elif inside < 1 and HEADERS.intersection(words):
            return -1
    return said


def part_of(name: str, attributes: str, inside: int) -> int:
    """1 if the element calls itself main text, -1 if surroundings, else 0; ``inside``
    is what its ancestors say."""
    if name in ("html", "body", "main"):
        return int(name == "main")
    if name in SURROUNDING or (name == "header" and inside < 1):
        return -1
    said = int(name == "article")
    if "=" in attributes or "hidden" in attributes:
        for key, value in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'").lower()
            if key in ("class", "id", "role"):
                now = named(value, inside)
                if now < 0:
                    return -1
                said = said or now
            elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "")):
                return -1
    return said


def blocks(page: str) -> list[tuple[str, int, int, bool, bool, int]]:
    """Flat text blocks in page order: text, its words, those in links, whether it's
    a heading, whether a list item, and what its ancestors say (1 main, -1 surroundings).

    Any input is read: unclosed and stray tags, comments that never end, references
    without semicolon. Time is linear in the page.
    """
    out = []
    texts: list[str] = []  # of the current block
    linked: list[str] = []
    open_: list[tuple[str, int]] = []  # block elements and what they and their ancestors say
    count: dict[str, int] = {}
    unseen, links, heading, items = 0, 0, 0, 0  # links: one more than the elements open where the link began

    def flush():
        text = " ".join("".join(texts).split())
        if text:
            n, of_links = text.count(" ") + 1, len("".join(linked).split())
            out.append((text, n, min(n, of_links), heading > 0, items > 0, open_[-1][1] if open_ else 0))
        texts.clear()
        linked.clear()

    def shut(name: str):
        nonlocal unseen, links, heading, items
        while True:
            top, _ = open_.pop()
            count[top] -= 1
            unseen -= top in UNSEEN
            heading -= top in HEADINGS
            items -= top == "li"
            if top == name:
                break
        links = links if len(open_) + 1 >= links else 0

    at, n = 0, len(page)
    while at < n:
        less = page.find("<", at)
        end = n if less < 0 else less
        if end > at and not unseen:
            text = html.unescape(page[at:end]) if "&" in page[at:end] else page[at:end]
            texts.append(text)
            if links:
                linked.append(text)
        if less < 0:
            break
        at = less
        if page.startswith("<!--", at):
            close = at + 4 if page.startswith((">", "->"), at + 4) else page.find("-->", at + 4)
            at = n if close < 0 else page.index(">", close) + 1
            continue
        follows = page[at + 1 : at + 3]
        if not follows[:1].isalpha() or not follows[:1].isascii():
            if follows[:1] in ("!", "?") or (follows[:1] == "/" and not (follows[1:].isalpha() and follows[1:].isascii())):
                close = page.find(">", at + 1)
                at = n if close < 0 else close + 1
                continue
            if follows[:1] != "/":  # not a tag
                if not unseen:
                    texts.append("<")
                    if links:
                        linked.append("<")
                at += 1
                continue
        tag = TAG.match(page, at)
        if tag is None:  # the page ends inside a tag
            break
        at = tag.end()
        closing, name, attributes = tag[1], tag[2].lower(), tag[3]
        if name in INLINE:
            if name == "a":
                links = 0 if closing else len(open_) + 1
            elif name == "br" and not unseen:
                texts.append(" ")
                if links:
                    linked.append(" ")
            continue
        flush()
        if closing:
            if count.get(name):
                shut(name)
            continue
        last = open_[-1][0] if open_ else ""
        if last == "p" or (last == name and name in SAME_ENDS) or (last == "head" and name not in IN_HEAD):
            shut(last)
        if name in VOID:
            continue
        inside = open_[-1][1] if open_ else 0
        open_.append((name, part_of(name, attributes, inside) or inside))
        count[name] = count.get(name, 0) + 1
        unseen += name in UNSEEN
        heading += name in HEADINGS
        items += name == "li"
        if name in RAW:
            close = re.compile(f"</{name}(?=[\\s/>])", re.I).search(page, at)
            at = n if close is None else close.start()
    flush()
    return out


def features(found: list[tuple]) -> np.ndarray:
    """A row for each block: words of it, of the one before and after; share of links
    in each; heading; list item; part."""
    out = np.zeros((len(found), 9))
    if found:
        words = np.array([b[1] for b in found], float)
        density = np.array([b[2] for b in found], float) / words
        out[:, 0], out[1:, 1], out[:-1, 2] = words, words[:-1], words[1:]
        out[:, 3], out[1:, 4], out[:-1, 5] = density, density[:-1], density[1:]
        out[:, 6:] = [b[3:] for b in found]
    return out


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 2):
    """A decision tree by Gini impurity: a share of main text, or (feature, bound, tree of
    rows up to the bound, tree of the others). Ties go to the earlier feature and lower bound."""
    share = float(y.mean()) if len(y) else 0.0
    if depth == 0 or share in (0.0, 1.0) or len(y) < 2 * least:
        return share
    best = None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, good = x[order, f], np.cumsum(y[order])
        k = np.flatnonzero(v[1:] > v[:-1]) + 1  # rows on the left of a split
        k = k[(k >= least) & (len(y) - k >= least)]
        if len(k):
            left, right = good[k - 1], good[-1] - good[k - 1]
            impurity = left * (k - left) / k + right * (len(y) - k - right) / (len(y) - k)
            i = int(impurity.argmin())
            if best is None or impurity[i] < best[0] - 1e-12:
                best = (float(impurity[i]), f, float(v[k[i] - 1] + v[k[i]]) / 2)
    if best is None or best[0] >= len(y) * share * (1 - share) - 1e-12:
        return share
    _, f, bound = best
    low = x[:, f] <= bound
    return f, bound, grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)


def grown(tree, x: np.ndarray) -> np.ndarray:
    """The share of main text that the tree gives each row."""
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, bound, low, high = tree
    out, side = np.empty(len(x)), x[:, f] <= bound
    out[side], out[~side] = grown(low, x[side]), grown(high, x[~side])
    return out


# The labelled table. Each line is a page as its blocks in order: a label
# (+ main text, - not), words, words in links, kind (p text, h heading, l list item) and
# part (m called main, s called surroundings, o neither), written as <label><words>/<links><kind><part>.
LABELLED = """
-1/1ls -1/1ls -1/1ls -1/1ls -12/0ps +9/0hm +85/0pm +40/0pm +1/0pm +120/2pm +3/0pm -14/0ps
-2/2ls -1/1ls -3/3ls +6/0hm +1/0pm +2/0pm +64/1pm +7/7pm +33/0pm -8/1ps -3/3ps
-1/1ls -2/2ls -9/0ps +5/0hm +24/0pm +9/0lm +12/0lm +5/5lm +18/4lm +51/0pm -40/0ps -65/0ps -11/2ps
-30/0ps -1/1ls -1/1ls +11/0hm +5/1pm +92/0pm +4/0hm +70/6pm +2/0pm -1/0hs -45/0ps -20/0ps -3/2ps
+8/0hm +130/0pm +75/3pm +1/1pm +6/0pm
-4/4ps -2/0hs -90/0ps -3/0hs -60/0ps +7/0hm +45/0pm +3/0pm
-6/0ps +3/0pm
+40/0pm -7/0ps +2/0pm -28/0ps +35/0pm
-1/1lo -1/1lo -2/2lo -1/1lo +8/0ho +60/0po +95/2po +6/0po +48/0po -9/2po -4/4po
-2/2po -3/3po -2/2po +7/0ho +35/0po +3/0po +80/4po +22/0po +1/0po +40/0po -5/5po -6/1po
-1/1lo -1/1lo +10/0ho +55/0po +14/0lo +17/1lo +11/0lo +72/0po -3/3lo -4/4lo -3/3lo -12/3po
-5/5po -1/0po -2/2po +6/0ho +28/0po +33/0po +2/0po +30/1po -2/0ho -6/6lo -7/7lo -5/5lo -8/1po
-3/3lo -2/2lo -2/2lo -3/3lo -1/1lo +12/0ho +140/0po +5/0ho +66/2po +90/0po -7/2po -2/2po -3/3po
+9/0ho +42/0po +58/0po +4/0po +37/0po
+25/0po
+3/0po
+120/0po +1/0po +60/0po
-4/0po -1/1po -2/2po -1/1po -6/3po
-1/1lo -2/2lo -1/1lo -3/1po -2/2po
+6/0ho +20/0po +31/3po +2/0po +44/0po -1/1po -1/1po -3/3po
-2/2po -2/2po +50/0po +3/0po +2/0po +47/0po +1/0po +20/0po -6/4po -2/2po
-5/0po -1/1lo -1/1lo -1/1lo +9/0ho +48/0po +70/0po +2/0po +36/0po -1/1po -6/0po -1/1po
-2/2po -4/0po -2/2po -3/0po -1/1po +7/0ho +31/0po +52/0po +1/0po +64/2po -2/2po -5/0po -2/2po -7/0po
-3/3po -6/0po -3/3po -2/2po -8/0po -3/3po +11/0ho +29/0po +4/0po +83/1po -4/4lo -3/0po -5/5lo
-1/1lo -2/0po -1/1lo -4/0po -2/2lo +44/0po +2/0po +39/0po +57/0po -3/3lo -1/0po -2/2lo
"""


def labelled(table: str = LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled table."""
    x, y = [], []
    for line in table.split("\n"):
        page = [re.fullmatch(r"([+-])(\d+)/(\d+)([phl])([mso])", b).groups() for b in line.split()]
        x.append(features([("", int(n), int(links), kind == "h", kind == "l", "som".index(part) - 1) for _, n, links, kind, part in page]))
        y.extend(sign == "+" for sign, *_ in page)
    return np.concatenate(x), np.array(y, float)


def main_text(page: str, tree) -> list[str]:
    """The blocks of ``page`` that ``tree`` takes for main text."""
    found = blocks(page)
    return [b[0] for b, share in zip(found, grown(tree, features(found))) if share >= 0.5]


def extract_text(pages: DataFrame, tree=None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", with_blocks: bool = False) -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text, n_chars``.

    ``text`` is the main text: its blocks in page order, white space inside each as one
    blank, joined by one blank; ``n_chars`` its code points. ``tree`` is one of ``grow``
    (by default, from the labelled table). ``with_blocks=True`` adds ``blocks``, each with
    its text and whether it was taken.

    A null or empty page, and one without main text, gives an empty text; null ids and
    URLs stay null; repeated rows give repeated rows; an empty table gives none; other
    columns are ignored. Pages are read whole, whatever their length.
    """
    tree = grow(*labelled()) if tree is None else tree
    source = pages.select(
        F.struct(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url")).alias("doc_id"), F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("text")
    )
    more = ", blocks array<struct<text: string, taken: boolean>>" if with_blocks else ""
    schema = T.StructType([source.schema["doc_id"], *T.StructType.fromDDL("text string, n_chars long" + more).fields])
    arrow = arrow_schema(schema)

    def run(batches):
        for ids, texts in text_batches(batches):
            # The blocks of a whole batch pass through the tree at once.
            found = [blocks(t) for t in texts]
            x = [features(f) for f in found]
            share = grown(tree, np.concatenate(x)) >= 0.5 if x else np.zeros(0, bool)
            at, out, every = 0, [], []
            for f in found:
                taken = share[at : at + len(f)]
                at += len(f)
                out.append(" ".join([b[0] for b, t in zip(f, taken) if t]))
                if with_blocks:
                    every.append([{"text": b[0], "taken": bool(t)} for b, t in zip(f, taken)])
            yield batch_of(arrow, [ids, out, list(map(len, out)), *([every] if with_blocks else [])])

    return source.mapInArrow(run, schema).select("doc_id.page_id", "doc_id.url", "text", "n_chars", *(["blocks"] if with_blocks else []))
