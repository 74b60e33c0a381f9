"""Main text of web pages: two passes of block rules.

A page is cut into blocks at block-level tags. Parts that are not article text by their
element or by a whole name in class, id or role (scripts, menus, footers, adverts, comments,
...) are boilerplate, unless they hold what they should stand beside: an element that holds
the page's article, or without article marks most of its words, is not ruled out by its
markup, as where a form or an unclosed menu spans the page. The first pass classifies the other
blocks by stop-word density, length and link density as good, bad (many links) or undecided;
the second gives an undecided block the label of its nearest decided neighbour, and a heading
that of the block after it. Both run inside and outside of elements that mark the article
(article, main); these are a prior for undecided blocks. A page is read in time linear in
its length, whatever its tags.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from hourglass.llm.common import sliced

#: fixed values: frequent short words of the languages read here
STOP_WORDS = frozenset("""
a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their there they
this to was we were which who will with you
der die das den dem des ein eine einer eines und oder aber ist sind war im in zu zum zur mit von vom für auf aus bei als
auch nicht sich es er sie wir ihr wie an
le la les un une des du de et ou est sont dans que qui pour par sur avec pas au aux ce cette il elle ne se plus
el los las una unos y o es son en del al por para con no su sus se lo como más
""".split())
#: least length of a decided block, and densities (shares of words)
SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.10, 0.20
LINK_HIGH = 0.4

#: fixed values: elements by what they are in HTML
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary
table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NEVER = frozenset("head script style noscript template title textarea iframe noembed noframes xmp svg math canvas object".split())
#: elements that are boilerplate unless they hold the page's article
ASIDE = frozenset("nav footer aside form button select menu dialog fieldset label option audio video map".split())
#: fixed values: elements that end where one of these begins, up to the element that holds them
IMPLIED = {"p": ({"p"}, BLOCK), "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
           "option": ({"option"}, {"select", "optgroup"})}
ARTICLE = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: fixed values: names in class, id or role that mark what is not article text
BOILER_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adsbygoogle taboola outbrain banner sponsor sponsored promo
promotion menu nav navbar navigation breadcrumb breadcrumbs sidebar aside footer masthead cookie cookies consent gdpr notice notices alert
popup modal overlay newsletter subscribe subscription signup login search share sharing social related recommended comment comments
commentlist respond replies reply disqus discussion pagination pager widget toolbar copyright legal disclaimer skip complementary
contentinfo""".split())
#: fixed values: words that may stand beside such a name in a longer one ("site-footer"); any other word makes it another name
BESIDE = frozenset("""site page top bottom left right wrapper wrap container box area section block inner outer list item items primary
secondary global bar unit slot link links post posts article entry user reader readers view text form main mobile desktop fixed sticky
center col column group thread body""".split())

_START = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)""", re.S)
_MARK = re.compile("[>\"']")
_NAME = re.compile(r"""(?:^|[\s"'/])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[^\W_]+")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}


def _named_boiler(attributes: str) -> bool:
    """Whether a whole name of the element marks boilerplate: such a word, or one with words
    that only tell where it stands. "has-sidebar" or "search-result" are other names."""
    if "=" not in attributes:
        return False
    for value in _NAME.findall(attributes):
        for name in value.strip("\"'").lower().split():
            words = _WORD.findall(name)
            if any(w in BOILER_NAMES for w in words) and all(w in BOILER_NAMES or w in BESIDE for w in words):
                return True
    return False


class _Tags:
    """Where start tags end. A quote without a partner is a plain character; where none is
    left is remembered, so that no page is searched for it again."""

    def __init__(self, html: str):
        self.html, self.none = html, {}

    def end(self, at: int) -> int:
        html = self.html
        while True:
            m = _MARK.search(html, at)
            if m is None:
                return len(html)
            if m[0] == ">":
                return m.end()
            close = -1 if m[0] in self.none else html.find(m[0], m.end())
            if close < 0:
                self.none[m[0]] = True
                at = m.end()
            else:
                at = close + 1


class _Page:
    """The open elements while a page is read, and the blocks so far."""

    def __init__(self):
        self.stack: list[tuple[str, int, int, bool]] = []  # tag, aside and mark outside of it, in a line
        self.open_tags: Counter[str] = Counter()
        self.article = self.link = self.skip = self.never = 0
        # elements that may be boilerplate: the one around each, whether it is so for sure, and its words
        self.aside, self.around, self.sure, self.words = 0, [0], [False], [0]
        # elements that mark the article: the one around each, the aside around it, and its words
        self.mark, self.mark_around, self.mark_aside, self.mark_words = 0, [0], [0], [0]
        self.blocks: list[tuple[str, int, int, bool, str]] = []
        self.text: list[str] = []
        self.linked = 0
        self.tag = ""

    def add(self, raw: str, decode: bool = True) -> None:
        if raw and not self.skip:  # boilerplate inside a line is no part of the line
            s = unescape(raw) if decode else raw
            self.text.append(s)
            if self.link:
                self.linked += len("".join(s.split()))

    def end_block(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            n = text.count(" ") + 1
            if not self.never:
                self.words[self.aside] += n
                self.mark_words[self.mark] += n
            self.blocks.append((text, self.linked, self.aside, self.article > 0, self.tag))
        self.text, self.linked, self.tag = [], 0, ""

    def _imply(self, tag: str) -> None:
        """Closes what ends where this tag begins."""
        ends, inside = IMPLIED[tag]
        if not any(self.open_tags[t] for t in ends):
            return
        for k in range(len(self.stack) - 1, -1, -1):
            here = self.stack[k][0]
            if here in ends:
                self.shut(k)
                return
            if here in inside:
                return

    def open(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.text.append("\n")
        if tag in BLOCK:
            self.end_block()
            self.tag = tag
        if tag in VOID:
            return
        if tag in IMPLIED:
            self._imply(tag)
            self.tag = tag if tag in BLOCK else self.tag
        never = tag in NEVER
        boiler = never or tag in ASIDE or (tag not in ("html", "body") and _named_boiler(attributes))
        if tag == "header" and not self.article:
            boiler = True
        in_line = boiler and tag not in BLOCK
        self.stack.append((tag, self.aside, self.mark, in_line))
        self.open_tags[tag] += 1
        self.never += never
        self.skip += in_line
        self.link += tag == "a"
        if boiler and not in_line:
            self.around.append(self.aside)
            self.sure.append(never)
            self.words.append(0)
            self.aside = len(self.around) - 1
        if tag in ARTICLE:
            self.article += 1
            if not boiler:
                self.mark_around.append(self.mark)
                self.mark_aside.append(self.aside)
                self.mark_words.append(0)
                self.mark = len(self.mark_around) - 1

    def shut(self, k: int) -> None:
        """Closes all elements from place k of the stack on."""
        if any(element[0] in BLOCK for element in self.stack[k:]):
            self.end_block()
        self.aside, self.mark = self.stack[k][1:3]
        for tag, _, _, in_line in self.stack[k:]:
            self.open_tags[tag] -= 1
            self.never -= tag in NEVER
            self.skip -= in_line
            self.article -= tag in ARTICLE
            self.link -= tag == "a"
        del self.stack[k:]

    def close(self, tag: str) -> None:
        if self.open_tags[tag]:
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] == tag:
                    self.shut(k)
                    return
        if tag in BLOCK:  # a stray end still separates
            self.end_block()

    def ruled_out(self) -> list[bool]:
        """Of each element that may be boilerplate, whether it or one around it is."""
        words, marked = self.words[:], self.mark_words[:]
        for k in range(len(words) - 1, 0, -1):
            words[self.around[k]] += words[k]
        for k in range(len(marked) - 1, 0, -1):
            marked[self.mark_around[k]] += marked[k]
        holds = [False] * len(words)  # the article, or most words of a page that marks none
        if max(marked[1:], default=0):
            k = self.mark_aside[max(range(1, len(marked)), key=lambda m: marked[m])]
            while k:
                holds[k] = True
                k = self.around[k]
        else:
            holds = [2 * n > words[0] for n in words]
        out = [False] * len(words)
        for k in range(1, len(words)):
            out[k] = out[self.around[k]] or self.sure[k] or not holds[k]
        return out


def blocks(html: str) -> list[tuple[str, int, bool, bool, str]]:
    """(text, characters in links, boilerplate by markup, in the article, tag) in page order."""
    page, tags, at, n = _Page(), _Tags(html), 0, len(html)
    unclosed: set[str] = set()
    while at < n:
        m = _START.search(html, at)
        if m is None:
            page.add(html[at:])
            break
        page.add(html[at : m.start()])
        at = m.end()
        if m[1]:
            page.close(m[1].lower())
        elif m[2]:
            tag, at = m[2].lower(), tags.end(m.end())
            page.open(tag, html[m.end() : at].removesuffix(">"))
            if tag in RAW:  # text up to its own end tag
                end = _RAW_END[tag].search(html, at) if tag not in unclosed else None
                if end is None:
                    unclosed.add(tag)  # found once, for all that follow
                stop = end.start() if end else n
                page.add(html[at:stop])
                at = stop
        elif m[0].startswith("<![CDATA["):
            page.add(m[0][9:].removesuffix("]]>"), decode=False)
    page.end_block()
    out = page.ruled_out()
    return [(text, linked, out[aside], inside, tag) for text, linked, aside, inside, tag in page.blocks]


def _first_pass(text: str, linked: int, tag: str, inside: bool = False) -> str:
    """good, bad, or an undecided kind: near good, rare (long, few stop words), short, heading,
    linked (many links, in the article)."""
    length = len(text)
    solid = len(text.replace(" ", ""))
    density = linked / max(solid, 1)
    if density > LINK_HIGH:
        return "linked" if inside else "bad"
    words = _WORD.findall(text.lower())
    stop = sum(w in STOP_WORDS for w in words) / max(len(words), 1)
    if stop >= STOP_HIGH and length > LONG:
        return "good"
    if tag in HEADINGS:
        return "heading"
    if length < SHORT:
        return "short"
    return "near good" if stop >= STOP_LOW else "rare"


def _decided(labels: list[str], inside: list[bool], edge: str, order: range) -> list[tuple[str, int]]:
    """Label and distance of the last decided block before each one in this order, on the
    same side of the article's border; the page's edge counts as `edge`, "" as no block."""
    out = [("", 0)] * len(labels)
    last: dict[bool, tuple[str, int]] = {}
    for step, k in enumerate(order):
        label, at = last.get(inside[k], (edge, -1))
        out[k] = (label, step - at)
        if labels[k] in ("good", "bad"):
            last[inside[k]] = (labels[k], step)
    return out


def _second_pass(labels: list[str], inside: list[bool] | None = None, edge: str = "bad") -> list[bool]:
    """Undecided blocks take their nearest decided neighbour's label, bad where two are as
    near; "near good" is good where one side is. A heading goes with the block after it.

    `inside` tells the blocks in the article, a prior for undecided ones: there they are bad
    only between two bad ones, and no label is passed over the article's border. What has no
    decided neighbour is good, but for short blocks outside an article that the page has.
    """
    n = len(labels)
    sides = inside or [False] * n
    marked = any(sides)
    before, after = _decided(labels, sides, edge, range(n)), _decided(labels, sides, edge, range(n - 1, -1, -1))
    out = [label == "good" for label in labels]
    for k in range(n - 1, -1, -1):
        near = [x for x in (before[k], after[k]) if x[0]]
        if labels[k] in ("good", "bad"):
            continue
        if sides[k]:
            out[k] = [label for label, _ in near] != ["bad", "bad"]
        elif labels[k] == "heading" and k + 1 < n:
            out[k] = out[k + 1]
        elif not near:
            out[k] = not marked or labels[k] in ("near good", "rare")
        elif labels[k] == "near good":
            out[k] = any(label == "good" for label, _ in near)
        else:
            least = min(d for _, d in near)
            out[k] = all(label == "good" for label, d in near if d == least)
    return out


def _linked_lines(labels: list[str], inside: list[bool]) -> list[str]:
    """A linked block is a line of the text, and undecided, only between two blocks of text in
    the article; else it is one of a list of links, or of a teaser, and bad."""
    def text_at(k: int) -> bool:
        return 0 <= k < len(labels) and inside[k] and labels[k] in ("good", "near good", "rare")

    return ["bad" if x == "linked" and not (text_at(k - 1) and text_at(k + 1)) else x for k, x in enumerate(labels)]


def main_text(html: str | None) -> str:
    found = [b for b in blocks(html or "") if not b[2]]  # what markup rules out is no neighbour
    inside = [in_article for *_, in_article, _ in found]
    labels = _linked_lines([_first_pass(text, linked, tag, i) for (text, linked, _, _, tag), i in zip(found, inside, strict=True)], inside)
    if "good" not in labels:  # the surest undecided kind stands for the text, in the article if it has some
        surest = next((x for x in ("near good", "rare", "short", "heading") if x in labels), "")
        within = any(i and x == surest for x, i in zip(labels, inside, strict=True))
        labels = ["good" if x == surest and i >= within else x for x, i in zip(labels, inside, strict=True)]
    return "\n".join(b[0] for b, keep in zip(found, _second_pass(labels, inside, edge=""), strict=True) if keep)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 128):
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """One row per page row: page_id, url, text, n_chars (code points of text).

    Null or empty html, or a page without main text, gives an empty text. Broken markup never
    hides the rest of a page: elements end where HTML lets them end, stray ends separate, an
    unclosed comment or script reaches to the end, and a menu or form that spans the article
    does not rule it out. The time is linear in the page, its open elements included. Null ids and urls
    stay; repeated rows come out as often as they went in; an empty table gives no rows.
    Blocks are never shortened and have no upper length. Other columns are not read.
    """
    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
