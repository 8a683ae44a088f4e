"""Main text of web pages: boosted trees judge the nodes of the page, a decoder makes the choices agree.

A page becomes a tree of its block elements; inline elements only add text and link text to the block
around them. Features of a node are its tag, the words of its class, id and role, the same of its ancestors,
its depth, its place among its siblings and how dense text, links and punctuation are below it. Boosted
trees give each node the probability that it holds main text. A node can only be kept if its parent is, so
the decoder looks for the choice of subtrees with the highest joint probability instead of judging nodes
one by one.

The trees are trained here, on pages that ``made_pages`` composes from layout rules with known answers and
on a bounded sample of the pages at hand that have one ``article``, whose elements name the answer.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillbook.llm import boost
from tillbook.llm.common import grouped, rows

SAMPLE = 200  # pages at hand that are learnt from, the ones whose address hashes lowest
MADE = 1_000  # composed pages
_BLOCK_CHARS = 1 << 21

# Elements by how HTML treats them (fixed values of the standard).
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_DROPPED = _RAW | frozenset("noscript template svg canvas object select button datalist audio video".split())
_MATH = frozenset(
    "math maction annotation annotation-xml merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt "
    "mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
_INLINE = _MATH | frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label map mark q s samp small span strike strong sub sup time tt u var ruby rt rp".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
# An element that starts ends an open one of these, unless one of the others lies between.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}

# Groups of tags and of words in class, id and role that are told apart.
_TAGS = (
    ("html", "body"), ("article",), ("main",), ("section",), ("div", "center"), ("p", "blockquote", "pre", "xmp"),
    ("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"), ("ul", "ol", "dl", "menu", "dir"), ("li", "dt", "dd"),
    ("table", "tbody", "thead", "tfoot", "tr", "td", "th"), ("figure", "figcaption"), ("nav",), ("header",), ("footer", "address"),
    ("aside",), ("form", "fieldset", "search", "dialog"),
)
_WORDS = (
    ("content", "article", "post", "body", "entry", "main", "text", "story", "prose", "page", "inhalt", "beitrag", "artikel", "contenu", "contenido", "articulo", "texte", "texto"),
    ("nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "tabs", "toc", "links", "navigationsleiste", "navegacion", "brotkrumen"),
    ("sidebar", "side", "aside", "rail", "widget", "complementary", "column", "seitenleiste", "randspalte", "laterale", "lateral", "colonne", "columna"),
    ("ad", "ads", "advert", "advertisement", "adverts", "banner", "promo", "promotion", "sponsor", "sponsored", "teaser", "offer", "werbung", "anzeige", "anzeigen", "publicite", "publicidad", "anuncio"),
    ("cookie", "cookies", "notice", "consent", "popup", "modal", "overlay", "gdpr", "alert", "privacy", "warning", "message", "paywall"),
    ("comment", "comments", "reply", "replies", "discussion", "disqus", "respond", "reviews", "feedback", "thread", "forum", "kommentar", "kommentare", "commentaire", "commentaires", "comentario", "comentarios"),
    ("header", "masthead", "top", "topbar", "logo", "brand", "site", "head", "kopf", "kopfzeile", "entete", "cabecera", "encabezado"),
    ("footer", "bottom", "copyright", "legal", "contentinfo", "foot", "imprint", "fuss", "fusszeile", "impressum", "pied", "pie"),
    ("form", "login", "search", "subscribe", "newsletter", "signup", "contact", "register", "subscription", "input"),
    ("share", "social", "sharing", "follow", "like", "tools", "toolbar", "buttons"),
    ("related", "recommended", "recommend", "more", "popular", "trending", "similar", "also", "latest", "aehnlich", "verwandt", "connexe", "relacionado", "relacionados"),
    ("meta", "byline", "author", "date", "tags", "info", "caption"),
)
_TAG_GROUP = {tag: k for k, group in enumerate(_TAGS) for tag in group}
_OTHER_TAG = _TAG_GROUP["div"]
_WORD_GROUP = {word: k for k, group in enumerate(_WORDS) for word in group}

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^>]*+\Z",
    re.S,
)
_NAMED = re.compile(r"(?<![^\s\"'/])(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_EMPTY = re.compile(r"(?<![^\s\"'])/\Z")  # the slash of <a/>, not the one of <a href=/>
_STOPS = re.compile(r"[.,;:!?]")


@lru_cache(maxsize=65_536)
def _words_of(attributes: str) -> int:
    """Bits of the groups that the words of class, id and role belong to."""
    bits = 0
    for value in _NAMED.findall(attributes):
        for part in _PART.findall(value):
            k = _WORD_GROUP.get(part.lower())
            if k is not None:
                bits |= 1 << k
    return bits


class Page:
    """Block elements of a page in the order they start, and the texts between their boundaries."""

    def __init__(self, source: str):
        self.tag, self.parent, self.named, self.mark = ["#"], [-1], [0], [""]
        self.blocks: list[tuple[int, str]] = []  # element and its text, in page order
        self.links: list[int] = []  # characters of link text per block
        self._read(source)

    def _read(self, source: str) -> None:
        open_at, open_tag = [0], ["#"]  # stack of elements; inline ones share the number of their block
        buffer: list[str] = []
        link_chars = in_link = 0
        position, end = 0, len(source)

        def flush():
            nonlocal link_chars
            if buffer:
                text = " ".join(html.unescape("".join(buffer)).split())
                if text:
                    self.blocks.append((open_at[-1], text))
                    self.links.append(min(link_chars, len(text)))
                buffer.clear()
            link_chars = 0

        def pop_to(depth: int):
            nonlocal in_link
            while len(open_tag) > depth:
                if open_tag[-1] not in _INLINE:
                    flush()
                elif open_tag[-1] == "a":
                    in_link -= 1
                open_at.pop()
                open_tag.pop()

        def find(wanted, barriers) -> int:
            for k in range(len(open_tag) - 1, 0, -1):
                if open_tag[k] in wanted:
                    return k
                if open_tag[k] in barriers:
                    return 0
            return 0

        while position < end:
            found = _TOKEN.search(source, position)
            stop = found.start() if found else end
            if stop > position:
                text = source[position:stop]
                buffer.append(text)
                if in_link:
                    link_chars += len(text)
            if not found:
                break
            position = found.end()
            closing, tag, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
            if not tag:
                continue
            tag = tag.lower()
            if closing:
                if tag in _INLINE:  # only if no block was opened since
                    for k in range(len(open_tag) - 1, 0, -1):
                        if open_tag[k] == tag:
                            pop_to(k)
                            break
                        if open_tag[k] not in _INLINE:
                            break
                elif tag == "br":
                    buffer.append(" ")
                elif tag not in _VOID:
                    k = find({tag}, {"td", "th", "table"} if tag not in ("td", "th", "tr", "tbody", "thead", "tfoot", "table", "body", "html") else set())
                    if k:
                        pop_to(k)
                continue
            if tag == "head":  # what cannot be in a head is in the body, whether or not the head was closed
                continue
            if tag in _VOID:
                if tag == "hr":
                    k = find({"p"}, ())
                    if k:
                        pop_to(k)
                    flush()
                else:
                    buffer.append(" ")
                continue
            if tag == "xmp":  # text as it is, tags and references too
                k = find({"p"}, {"td", "th", "table"})
                if k:
                    pop_to(k)
                flush()
                ended = re.compile(r"</xmp(?=[\s/>])[^>]*>", re.I).search(source, position)
                inside = source[position : ended.start() if ended else end]
                self.parent.append(open_at[-1])
                self.tag.append(tag)
                self.named.append(_words_of(attributes) if attributes else 0)
                self.mark.append(attributes)
                open_at.append(len(self.tag) - 1)
                buffer.append(html.escape(inside))
                flush()
                open_at.pop()
                position = ended.end() if ended else end
                continue
            if tag in _DROPPED:
                buffer.append(" ")
                if tag != "svg" or not attributes.endswith("/"):
                    position = self._skip(source, position, tag, {t for t in open_tag if t not in _INLINE})
                continue
            if tag in _INLINE:
                if not _EMPTY.search(attributes) or tag != "a" and tag not in _MATH:
                    open_at.append(open_at[-1])
                    open_tag.append(tag)
                    in_link += tag == "a"
                continue
            if tag in _CLOSES_P:
                k = find({"p"}, {"td", "th", "table"})
                if k:
                    pop_to(k)
            if tag in _ENDS:
                k = find(*_ENDS[tag])
                while k:
                    pop_to(k)
                    k = find(*_ENDS[tag])
            flush()
            open_at.append(len(self.tag))
            open_tag.append(tag)
            self.parent.append(open_at[-2])
            self.tag.append(tag)
            self.named.append(_words_of(attributes) if attributes else 0)
            self.mark.append(attributes)
        flush()

    @staticmethod
    def _skip(source: str, position: int, tag: str, outside: set[str]) -> int:
        """End of an element whose inside is no text: its end tag, or else where an element around it ends.

        As in HTML, raw text that is not closed reaches to the end of the page.
        """
        if tag in _RAW:
            found = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, position)
            return found.end() if found else len(source)
        if tag in ("template", "object"):  # end tags of what is around them do not count inside
            depth, start, both = 1, position, re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>", re.I)
            while found := both.search(source, start):
                depth += -1 if found.group(1) else 1
                start = found.end()
                if not depth:
                    return start
        inside: list[str] = []
        while found := _TOKEN.search(source, position):
            closing, name, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
            name = (name or "").lower()
            if closing:
                if name in inside:
                    del inside[len(inside) - 1 - inside[::-1].index(name) :]
                elif name == tag:
                    return found.end()
                elif name in outside:
                    return found.start()
            position = found.end()
            if not name or closing or name in _VOID or attributes.endswith("/") or name == tag in ("button", "select"):
                continue
            if name in _RAW and tag != "svg" and "svg" not in inside:
                position = Page._skip(source, position, name, outside)
            else:
                inside.append(name)
        return len(source)


def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all nodes of all pages in a row, their parents (-1 for roots) and their depths."""
    sizes = np.array([len(p.tag) for p in pages])
    offset = np.cumsum(sizes) - sizes
    page = np.repeat(np.arange(len(pages)), sizes)
    parent = np.concatenate([np.array(p.parent) for p in pages]) + offset[page]
    root = np.zeros(len(page), bool)
    root[offset] = True
    parent[root] = -1
    tag = np.array([_TAG_GROUP.get(t, _OTHER_TAG) for p in pages for t in p.tag])
    named = np.array([b for p in pages for b in p.named])
    n = len(page)
    depth = np.zeros(n, np.int64)
    levels = [np.flatnonzero(root)]
    below = np.argsort(parent, kind="stable")
    first, last = np.searchsorted(parent[below], np.arange(n)), np.searchsorted(parent[below], np.arange(n), side="right")
    while len(levels[-1]):
        current = levels[-1]
        count = last[current] - first[current]
        if not count.sum():
            break
        at = np.repeat(first[current] - np.cumsum(count) + count, count) + np.arange(count.sum())
        levels.append(below[at])
        depth[below[at]] = len(levels) - 1

    owner = np.array([offset[k] + node for k, p in enumerate(pages) for node, _ in p.blocks], np.int64)
    chars = np.array([len(t) for p in pages for _, t in p.blocks], float)
    linked = np.array([c for p in pages for c in p.links], float)
    spaces = np.array([t.count(" ") + 1 for p in pages for _, t in p.blocks], float)
    stops = np.array([len(_STOPS.findall(t)) for p in pages for _, t in p.blocks], float)

    def own(values):
        return np.bincount(owner, values, n) if len(owner) else np.zeros(n)

    sums = np.stack([own(chars), own(linked), own(spaces), own(stops), own(np.ones(len(owner))), np.ones(n), (tag == _TAG_GROUP["p"]).astype(float)])
    own_chars = sums[0].copy()
    longest = np.zeros(n)
    np.maximum.at(longest, owner, chars)
    text_before = np.zeros(n)
    if len(owner):  # text of the page that comes before a node's own first text, carried up to its ancestors
        upto = np.cumsum(chars) - chars
        page_first = np.searchsorted(page[owner], np.arange(len(pages)))
        base = np.where(page_first < len(upto), upto[np.minimum(page_first, len(upto) - 1)], 0)
        text_before[:] = np.inf
        np.minimum.at(text_before, owner, upto - base[page[owner]])
    for level in reversed(levels[1:]):
        for row in sums:
            np.add.at(row, parent[level], row[level])
        np.maximum.at(longest, parent[level], longest[level])
        np.minimum.at(text_before, parent[level], text_before[level])
    text_before[~np.isfinite(text_before)] = 0
    above_tag, above_named = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for level in levels[1:]:
        up = parent[level]
        above_tag[level] = above_tag[up] | 1 << tag[up]
        above_named[level] = above_named[up] | named[up]
    total, link, word, stop, block, nodes, paragraphs = sums
    up = np.where(root, np.arange(n), parent)
    siblings = np.bincount(parent[~root], minlength=n)[up]
    earlier = np.empty(n)
    earlier[below] = np.arange(n) - first[np.maximum(parent[below], 0)]
    page_chars = np.maximum(total[offset][page], 1)
    prior = np.arange(n)  # the sibling before
    later = earlier[below] > 0
    prior[below[later]] = below[np.flatnonzero(later) - 1]
    lone = prior == np.arange(n)
    columns = [
        *((tag == k) for k in range(len(_TAGS))), *((above_tag >> k & 1) for k in range(1, len(_TAGS))),
        *((named >> k & 1) for k in range(len(_WORDS))), *((above_named >> k & 1) for k in range(len(_WORDS))),
        depth, np.log1p(total), link / np.maximum(total, 1), total / nodes, stop / np.maximum(word, 1), np.log1p(own_chars),
        np.log1p(longest), total / np.maximum(block, 1), np.log1p(paragraphs), np.log1p(nodes), total / page_chars,
        text_before / page_chars, siblings, earlier / np.maximum(siblings, 1), total / np.maximum(total[up], 1),
        paragraphs[up] / np.maximum(nodes[up], 1), np.log1p(longest[up]), link[up] / np.maximum(total[up], 1),
        np.where(lone, -1, tag[prior]), np.where(lone, -1, np.log1p(total[prior])), (tag == tag[prior]) & (named == named[prior]) & ~lone,
    ]
    return np.stack([np.asarray(c, float) for c in columns], axis=1), parent, depth


_LINKED = 2 * len(_TAGS) - 1 + 2 * len(_WORDS) + 2  # the feature that tells which part of the text is in links


def decode(score: np.ndarray, parent: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Which nodes are kept: the most probable choice in which a kept node has a kept parent; roots are kept."""
    keep, drop = -np.logaddexp(0, -score), -np.logaddexp(0, score)  # log probabilities
    all_dropped, best = drop.copy(), keep.copy()
    order = [np.flatnonzero(depth == d) for d in range(int(depth.max(initial=0)) + 1)]
    for level in reversed(order[1:]):
        np.add.at(best, parent[level], np.maximum(best[level], all_dropped[level]))
        np.add.at(all_dropped, parent[level], all_dropped[level])
    kept = np.zeros(len(score), bool)
    kept[parent < 0] = True
    for level in order[1:]:
        kept[level] = kept[parent[level]] & (best[level] >= all_dropped[level])
    return kept


def main_texts(sources: list[str], model: boost.Trees) -> list[str]:
    pages = [Page(source) for source in sources]
    if not pages:
        return []
    x, parent, depth = features(pages)
    score = model.score(x)
    tags = [t for p in pages for t in p.tag]
    score[[k for k, t in enumerate(tags) if t in ("#", "html", "body")]] = 30.0  # every page has them
    score[x[:, _TAG_GROUP["nav"]].astype(bool) & (x[:, _LINKED] > 0.5)] = -30.0  # links to elsewhere by meaning and content
    kept = decode(score, parent, depth)
    out, base = [], 0
    for page in pages:
        out.append("\n\n".join(text for node, text in page.blocks if kept[base + node]))
        base += len(page.tag)
    return out


# -- pages with known answers -------------------------------------------------------------------

_KEEP = "data-keep"


def made_pages(n: int, seed: int = 11) -> list[str]:
    """Pages composed from layout rules; elements whose own text is main text carry an attribute."""
    dice = random.Random(seed)
    syllables = [a + b for a in "b d f g h k l m n p r s t v w z th st er on".split() for b in "a e i o u an en in ou".split()]

    def word():
        return "".join(dice.choices(syllables, k=dice.choice((1, 1, 2, 2, 3))))

    def words(low, high):
        text = [word() + dice.choice(["", "", "", "", "", ",", "."]) for _ in range(dice.randint(low, high))]
        return " ".join(text).capitalize() + dice.choice([".", ".", ""])

    def name(*choices):
        """Now and then no name, or one that tells nothing."""
        kind = dice.random()
        if kind < 0.2:
            return ""
        if kind < 0.35:
            return f' class="{word()}-{dice.randint(1, 99)}"'
        return f' {dice.choice(["class", "class", "id"])}="{dice.choice(choices)}"'

    def links(low, high):
        return "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(dice.randint(low, high)))

    def menu():
        tag = dice.choice(["nav", "nav", "div", "ul"])
        inside = links(3, 9) if tag == "ul" else f"<ul>{links(3, 9)}</ul>"
        if tag == "nav" and dice.random() < 0.3:
            inside = " ".join(f'<a href="/{word()}">{words(1, 3)}</a>' for _ in range(dice.randint(1, 6)))
        return f'<{tag}{name("nav", "menu", "navbar", "main-menu", "breadcrumbs") if tag != "nav" else ""}>{inside}</{tag}>'

    def advert():
        tag = dice.choice(["div", "div", "aside", "section", "p"])
        named = f' {dice.choice(["class", "id"])}="{dice.choice(["ad", "ads", "advert", "banner", "promo", "sponsored", "ad-box"])}"'
        return f"<{tag}{named}>{words(2, 40)}</{tag}>"

    def notice():
        return f'<div class="{dice.choice(["cookie", "cookie-notice", "notice", "consent", "popup", "alert", "gdpr-banner"])}">{dice.choice(["", "<p>"])}{words(4, 40)} <button>{word()}</button></div>'

    def head():
        tag = dice.choice(["header", "div"])
        return f'<{tag}{name("header", "masthead", "site-header", "top") if tag == "div" else ""}><a href="/">{words(1, 4)}</a>{dice.choice(["", menu(), f"<p>{words(2, 8)}</p>", f"<h1>{words(1, 4)}</h1>"])}</{tag}>'

    def foot():
        tag = dice.choice(["footer", "footer", "div"])
        return f'<{tag}{name("footer", "site-footer", "bottom", "copyright") if tag == "div" else ""}>{dice.choice(["&copy; ", "", "<p>"])}{words(2, 40)}{dice.choice(["", f"<ul>{links(2, 5)}</ul>"])}</{tag}>'

    def form():
        return f'<form{name("newsletter", "subscribe", "search", "login")}><p>{words(2, 15)}</p><label>{words(1, 3)}</label><input name="q"><button>{word()}</button></form>'

    def share():
        return f'<div class="{dice.choice(["share", "social", "share-tools"])}">{"".join(f"<a href=#>{word()}</a> " for _ in range(4))}</div>'

    def related():
        return f'<{(tag := dice.choice(["div", "section", "aside"]))} class="{dice.choice(["related", "more", "recommended", "popular"])}"><h3>{words(1, 3)}</h3><ul>{links(3, 6)}</ul></{tag}>'

    def comments():
        tag = dice.choice(["section", "div", "div", "ol", "aside"])
        item = "li" if tag == "ol" else dice.choice(["div", "article", "p", "li"])
        each = "".join(
            f'<{item}{dice.choice(["", " class=comment", " class=reply"])}>{dice.choice(["", f"<b>{word()}</b> ", f"<span>{word()}</span>"])}'
            f'{words(2, 60) if item == "p" else "<p>" + words(2, 60) + "</p>"}</{item}>' for _ in range(dice.randint(1, 6))
        )
        return f'<{tag} {dice.choice(["class", "id"])}="{dice.choice(["comments", "comment-list", "discussion", "respond", "replies"])}">{dice.choice(["", f"<h2>{words(1, 3)}</h2>"])}{each}</{tag}>'

    def side():
        tag = dice.choice(["aside", "div"])
        parts = [dice.choice([f"<h3>{words(1, 3)}</h3><ul>{links(3, 7)}</ul>", f"<p>{words(4, 40)}</p>", advert(), form()]) for _ in range(dice.randint(1, 3))]
        return f'<{tag}{dice.choice(["", " class=sidebar", " id=side"]) if tag == "aside" else f" class={dice.choice(['sidebar', 'widget', 'right-rail', 'side-column'])}"}>{"".join(parts)}</{tag}>'

    def text(low=1, high=150):
        inner = words(low, dice.randint(low, high))
        if dice.random() < 0.2:
            inner = f"<b>{inner}</b>" if dice.random() < 0.5 else f'{inner} <a href="/{word()}">{words(1, 3)}</a> {words(1, 9)}'
        return inner

    def body():
        parts = [f"<h1 {_KEEP}>{words(2, 12)}</h1>"] if dice.random() < 0.85 else []
        for _ in range(dice.randint(1, 14)):
            kind = dice.random()
            if kind < 0.02:
                parts.append(f"<aside><p {_KEEP}>{words(8, 60)}</p></aside>")
            elif kind < 0.8:
                parts.append(f"<p {_KEEP}>{text()}" + ("</p>" if dice.random() < 0.9 else "<br>"))
            elif kind < 0.86:
                parts.append(f"<h{(k := dice.randint(2, 4))} {_KEEP}>{words(1, 8)}</h{k}>")
            elif kind < 0.91:
                parts.append("<ul>" + "".join(f"<li {_KEEP}>{text(1, 25)}</li>" for _ in range(dice.randint(2, 6))) + "</ul>")
            elif kind < 0.94:
                parts.append(f"<blockquote {_KEEP}>{text(3, 40)}{dice.choice(['', '', f'<footer {_KEEP}>{words(1, 8)}</footer>'])}</blockquote>")
            elif kind < 0.96:
                parts.append("<table>" + "".join(f"<tr><td {_KEEP}>{words(1, 4)}</td><td {_KEEP}>{words(1, 4)}</td></tr>" for _ in range(3)) + "</table>")
            elif kind < 0.98:
                parts.append(f"<figure><img src=x><figcaption {_KEEP}>{words(3, 12)}</figcaption></figure>")
            else:
                parts.append(f"<pre {_KEEP}>{words(3, 30)}</pre>")
        for extra in (advert, share, related, form, notice):
            if dice.random() < 0.12:
                parts.insert(dice.randint(1, len(parts)), extra())
        if dice.random() < 0.15:
            parts.append(comments())
        return "".join(parts)

    def maybe(chance, part):
        return part() if dice.random() < chance else ""

    def page():
        tag = dice.choice(["article", "article", "article", "div", "div", "main", "section"])
        named = name("content", "post-body", "entry-content", "article-body", "story", "main-text") if tag in ("div", "section") else dice.choice(["", name("post", "content")])
        content = f"<{tag}{named}>{body()}</{tag}>"
        if dice.random() < 0.3:
            content = f"<main{name('main', 'page')}>{maybe(0.3, head)}{content}{maybe(0.3, related)}{maybe(0.3, comments)}</main>"
        elif dice.random() < 0.3:
            content = f"<div{name('wrapper', 'container', 'page', 'row')}>{content}{maybe(0.5, side)}{maybe(0.3, comments)}</div>"
        if dice.random() < 0.1:  # nothing but the text, its end a short paragraph
            last = f"<p {_KEEP}>{words(1, 8)}</p>"
            inside = "".join(f"<p {_KEEP}>{words(5, 120)}</p>" for _ in range(dice.randint(1, 6)))
            return dice.choice(["<article>{}</article>", "<body><article>{}</article></body>", "<div>{}</div>", "{}"]).format(f"<h1 {_KEEP}>{words(1, 9)}</h1>{inside}{last}")
        if dice.random() < 0.1:  # a page without an article
            content = dice.choice([menu, menu, advert, notice, foot, form, side])()
            if dice.random() < 0.5:
                return f"<body>{content}</body>"
        before = [maybe(0.5, head), maybe(0.25, notice), maybe(0.6, menu), maybe(0.5, advert)]
        after = [maybe(0.4, side), maybe(0.35, comments), maybe(0.25, related), maybe(0.25, form), maybe(0.2, advert), maybe(0.15, notice), maybe(0.8, foot)]
        dice.shuffle(after) if dice.random() < 0.2 else None
        if dice.random() < 0.1:  # a form around the whole page
            before.insert(0, f'<form{dice.choice(["", " method=post", f" id={word()}"])}>')
            after.append("</form>")
        return f"<!DOCTYPE html><html><head><title>{words(2, 8)}</title></head><body>{''.join(before)}{content}{''.join(after)}</body></html>"

    return [page() for _ in range(n)]


_NEVER = frozenset("nav footer aside form header".split())
_NEVER_WORDS = sum(1 << k for k in (1, 2, 3, 4, 5, 7, 8, 9, 10))


def _answers(page: Page, made: bool) -> np.ndarray | None:
    """1 for nodes that hold main text somewhere below; None if the page does not tell."""
    n = len(page.tag)
    own = np.zeros(n, bool)
    if made:
        own[[k for k in range(n) if _KEEP in page.mark[k]]] = True
    else:
        if page.tag.count("article") != 1:
            return None
        inside = np.zeros(n, bool)
        for k in range(1, n):
            inside[k] = page.tag[k] == "article" or inside[page.parent[k]]
            inside[k] &= page.tag[k] not in _NEVER and not page.named[k] & _NEVER_WORDS
        own = inside
    for k in range(n - 1, 0, -1):
        own[page.parent[k]] |= own[k]
    return own


def train(sample: list[str]) -> boost.Trees:
    pages, answers = [], []
    for source, made in [(s, True) for s in made_pages(MADE)] + [(s, False) for s in sample]:
        page = Page(source)
        answer = _answers(page, made)
        if answer is not None:
            pages.append(page)
            answers.append(answer)
    x, _, _ = features(pages)
    return boost.fit(x, np.concatenate(answers).astype(float))


@dataclass(frozen=True)
class _Run:
    model: boost.Trees

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in grouped(rows(batches), lambda r: len(r[2] or ""), _BLOCK_CHARS):
            texts = main_texts([source or "" for _, _, source in part], self.model)
            yield pa.RecordBatch.from_pydict({
                "page_id": pa.array([r[0] for r in part], pa.int64()), "url": pa.array([r[1] for r in part], pa.string()),
                "text": pa.array(texts, pa.string()),
            })


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text (empty if none) and n_chars, a row for each row of (page_id, url, html).

    Null and empty pages have no text. Blocks are joined by an empty line in page order; white space inside
    a block becomes one space and character references are decoded. Ids and addresses may be null or
    repeat; other columns are ignored.
    """
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    place = F.xxhash64("url", "page_id")
    full = source.filter("html IS NOT NULL")
    lowest = full.select(place.alias("place")).orderBy("place").limit(SAMPLE).agg(F.max("place")).first()[0]  # numbers only
    chosen = full.filter(place <= F.lit(lowest)).select("page_id", "url", "html") if lowest is not None else full.limit(0)
    sample = chosen.orderBy(place, "page_id", "url", "html").limit(SAMPLE).select("html").collect()
    model = train([row["html"] for row in sample])
    return source.mapInArrow(_Run(model), "page_id long, url string, text string").withColumn("n_chars", F.char_length("text").cast("long"))
