"""Main text of web pages: block rules in two passes."""

from __future__ import annotations

import heapq
import re
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import single_threaded

# Elements that start and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "tfoot thead title tr ul".split()
)
# Elements whose content is no text of the page.
SILENT = frozenset(
    "applet audio button canvas datalist embed head iframe map noframes noscript object option script select style "
    "svg template textarea title video".split()
)
# Of these, elements whose content is not markup.
RAW = frozenset("iframe noframes noscript script style textarea title".split())
# Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements around what is not the article, and those around the article.
AROUND = frozenset("aside footer menu nav".split())
# Elements around what is not the article, unless they hold the page's article.
HOLDERS = frozenset("dialog form".split())
INSIDE = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of class and id names, and of roles, that mark such surroundings.
MARKS = frozenset(
    "ad ads adsense advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices "
    "pager pagination popup promo promotion recommended related reply respond search share sharing sidebar signup social "
    "sponsor sponsored subscribe subscription toolbar widget complementary contentinfo".split()
)
# Before a mark, words by which a name says only what an element has or lacks.
MODIFIERS = frozenset("has have with without no not non is hide show".split())
# Marks of what may well be longer than the article itself.
TALK = frozenset("comment comments disqus reply respond related recommended".split())
# Frequent function words of four languages.
STOP = frozenset(
    "a about after all also an and any are as at be because been but by can could did do for from had has have he her his "
    "how i if in into is it its more not of on one or other our out over she so some such than that the their them then "
    "there these they this to up was we were what when which who will with would you "
    "aber als am auch auf aus bei bis das dass dem den der des die doch durch ein eine einem einen einer er es für haben "
    "hat ich ihr im ist kann man mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor war was wenn "
    "werden wie wird wir zu zum zur "
    "au aux avec ce ces cette comme dans de des du elle en est et eux il ils je la le les leur lui mais même ne nous on ou "
    "où par pas plus pour qu que qui sa sans se ses son sur un une vous "
    "al como con cual cuando de del desde donde el ella en entre era es esta este fue ha hay la las le lo los más me mi muy "
    "no nos o para pero por porque que se ser si sin sobre son su sus también tiene todo un una uno y ya".split()
)
# A block of fewer characters is short; above that share of links it is a list of links.
SHORT = 70
LONG = 200
LINKS = 0.5
STOP_LOW, STOP_HIGH = 0.10, 0.20

NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WORDS = re.compile(r"[^\W\d_]+")
PARTS = re.compile(r"[^a-z0-9]+")
QUOTED = re.compile(r"[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+>")

GOOD, BAD, OPEN = 1, 0, None


def _hidden(attributes: str) -> bool:
    """Whether an element is not shown."""
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), (a or b or c).lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def _marks(attributes: str) -> set[str]:
    """The marks in an element's names, which say that it may not be part of an article."""
    found = set()
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        if key.lower() in ("class", "id", "role"):
            for name in (a or b or c).lower().split():
                for part in PARTS.split(name):
                    if part in MODIFIERS:
                        break
                    if part in MARKS:
                        found.add(part)
    return found


class Block:
    """Text between two block boundaries, with what is known of its surroundings."""

    __slots__ = ("text", "linked", "inside", "around", "heading", "named", "_density")

    def __init__(self, text: str, linked: int, inside: bool, around: bool, heading: bool, named: int):
        self.text, self.linked, self.inside, self.around, self.heading = text, linked, inside, around, heading
        self.named, self._density = named, None

    @property
    def density(self) -> float:
        """The share of function words."""
        if self._density is None:
            words = [w.lower() for w in WORDS.findall(self.text)]
            self._density = sum(w in STOP for w in words) / max(1, len(words))
        return self._density


class Named:
    """An element whose names mark it as surroundings: the one around it (-1: none), its articles."""

    __slots__ = ("outer", "talk", "articles")

    def __init__(self, outer: int, talk: bool):
        self.outer, self.talk, self.articles = outer, talk, 0


def _settle(page: list[Block], named: list[Named], articles: int) -> None:
    """Mark the blocks below named elements as surroundings, except below those that hold the page's article.

    An element does if it holds an article and none is outside of named ones, or if it holds
    more good text than there is outside; one of comments or the like, only if there is none
    outside. Outer elements are settled first, then those with more good text.
    """
    own = [0] * (len(named) + 1)  # the last one: outside of all
    for block in page:
        good = block.linked <= LINKS * len(block.text) and (
            block.inside or (len(block.text) >= SHORT and not block.heading and block.density >= STOP_LOW)
        )
        own[block.named] += len(block.text) * (good and not block.around)
    whole, held = own[:-1], [n.articles for n in named]
    inner: list[list[int]] = [[] for _ in range(len(named) + 1)]
    for k in range(len(named) - 1, -1, -1):
        outer = named[k].outer
        inner[outer].append(k)
        if outer >= 0:
            whole[outer] += whole[k]
            held[outer] += held[k]
    clean, exempt = own[-1], [False] * len(named) + [True]
    order = lambda k: (named[k].talk, not held[k], -whole[k], k)
    heap = [(order(k), k) for k in inner[-1]]
    heapq.heapify(heap)
    while heap:
        _, k = heapq.heappop(heap)
        if named[k].talk:
            holds = whole[k] > 0 and not clean
        else:
            holds = whole[k] > clean or (held[k] > 0 and not articles)
        if holds:
            exempt[k] = True
            clean += own[k]
            articles += named[k].articles
            for m in inner[k]:
                heapq.heappush(heap, (order(m), m))
    for block in page:
        block.around = block.around or not exempt[block.named]


def blocks(html: str) -> list[Block]:
    """The blocks of a page that have text, in page order.

    One forward pass; open elements are a stack, and an end tag closes all that is open
    above its start tag. Comments, scripts and the like have no text; if one does not end,
    the page ends with it. Something that looks like a tag without an end is text.
    """
    found: list[Block] = []
    stack: list[tuple[str, bool, int]] = []
    named: list[Named] = []
    current, articles = -1, 0
    opened: dict[str, int] = {}
    depth = {"around": 0, "inside": 0, "silent": 0, "a": 0, "heading": 0}
    parts: list[str] = []
    linked: list[str] = []

    def close_block() -> None:
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                links = len(" ".join(unescape("".join(linked)).split())) if linked else 0
                found.append(Block(text, links, depth["inside"] > 0, depth["around"] > 0, depth["heading"] > 0, current))
            parts.clear()
            linked.clear()

    def count(name: str, around: bool, step: int) -> None:
        if around:
            depth["around"] += step
        if name in INSIDE and not around:
            depth["inside"] += step
        if name in SILENT:
            depth["silent"] += step
        if name == "a":
            depth["a"] += step
        if name in HEADINGS:
            depth["heading"] += step

    def text(value: str) -> None:
        if value and not depth["silent"]:
            parts.append(value)
            if depth["a"]:
                linked.append(value)

    at, end, quotes = 0, len(html), True
    lower = None
    while at < end:
        start = html.find("<", at)
        if start < 0:
            text(html[at:])
            break
        if start > at:
            text(html[at:start])
        if html.startswith("<!--", start):
            stop = html.find("-->", start + 4)
            if stop < 0:
                break
            at = stop + 3
            continue
        if html.startswith(("<!", "<?"), start):
            stop = html.find(">", start)
            at = end if stop < 0 else stop + 1
            continue
        closing = html.startswith("</", start)
        name = NAME.match(html, start + 1 + closing)
        if not name:
            text("<")
            at = start + 1
            continue
        stop = html.find(">", name.end())
        if stop < 0:
            text(html[start:])
            break
        attributes = html[name.end() : stop]
        if quotes and (attributes.count('"') % 2 or attributes.count("'") % 2):
            whole = QUOTED.match(html, name.end())
            if whole:
                stop = whole.end() - 1
                attributes = html[name.end() : stop]
            else:
                quotes = False  # a quote that never ends: from here on tags end at the next bracket
        tag, at = name.group().lower(), stop + 1
        if tag in BLOCKS:
            close_block()
        elif tag in ("br", "td", "th"):
            text(" ")
        if closing:
            if opened.get(tag):
                while stack:
                    last, around, current = stack.pop()
                    opened[last] -= 1
                    count(last, around, -1)
                    if last == tag:
                        break
            continue
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
            continue
        around = tag in AROUND or (tag == "header" and not depth["inside"])
        marks: set[str] = {tag} if tag in HOLDERS else set()
        if not around and attributes and tag not in ("html", "body") and (tag not in INSIDE or depth["inside"] > 0):
            around = _hidden(attributes)
            marks |= _marks(attributes)
            if depth["inside"]:
                marks = set() if tag in HEADINGS or tag in ("header", "hgroup") and marks <= {"header", "banner"} else marks - {"header"}
        if tag in RAW:
            lower = lower or html.lower()
            if len(lower) != len(html):  # lower case of another length: look for the end as it is written
                lower = html
            stop = lower.find(f"</{tag}", at)
            if stop < 0:
                break
            at = html.find(">", stop)
            at = end if at < 0 else at + 1
            continue
        if tag == "p" and stack and stack[-1][0] == "p":
            opened["p"] -= 1
            last, out, current = stack.pop()
            count(last, out, -1)
        stack.append((tag, around, current))
        if marks:
            named.append(Named(current, not TALK.isdisjoint(marks)))
            current = len(named) - 1
        elif tag in INSIDE and not around and not depth["around"]:
            if current < 0:
                articles += 1
            else:
                named[current].articles += 1
        opened[tag] = opened.get(tag, 0) + 1
        count(tag, around, 1)
    close_block()
    if named:
        _settle(found, named, articles)
    return found


def _listed(page: list[Block]) -> bool:
    """Whether the page's language has a list of function words: whether its running text holds any number of them."""
    told = [b for b in page if not b.around and not b.heading and b.linked <= LINKS * len(b.text)]
    return sum(b.density * len(b.text) for b in told) >= STOP_LOW * sum(len(b.text) for b in told)


def _first_pass(block: Block, framed: bool, listed: bool) -> int | None:
    """A block's own label, or None if it is too short or too plain to tell.

    ``framed``: the page marks its article. Then nothing outside of it is part of it, and
    what is inside needs no function words to stay. ``listed``: the page's language has a
    list of function words. If not, length and the share of links decide.
    """
    if block.around or (framed and not block.inside):
        return BAD
    share = block.linked / len(block.text)
    if share > LINKS:
        return OPEN if block.inside and share < 1 else BAD
    if block.heading:
        return OPEN
    if not framed and not listed:
        # Scripts without blanks say as much in a third of the characters.
        least = SHORT if block.text.isascii() or len(block.text.split()) * 12 > len(block.text) else SHORT // 3
        return GOOD if len(block.text) >= least and share <= LINKS / 2 else OPEN
    if len(block.text) < SHORT:
        return OPEN
    if block.density >= STOP_HIGH:
        return GOOD
    if block.density >= STOP_LOW:
        return GOOD if len(block.text) >= LONG else OPEN
    return OPEN


def main_blocks(page: list[Block]) -> list[Block]:
    """The blocks of the main text, by rules in two passes.

    First each block is judged by its surroundings, length, share of links and density of
    function words. Then those left open get the label of the nearest decided neighbours:
    good if either is; a heading that of the next. Inside of a marked article only that
    article's blocks are neighbours, and what has none is good. On a page without a good block
    those left open are the text.
    """
    framed = any(b.inside and not b.around for b in page)
    listed = framed or _listed(page)
    labels = [_first_pass(b, framed, listed) for b in page]
    after: list[int | None] = [None] * len(page)
    nearest = None
    for k in range(len(page) - 1, -1, -1):
        if labels[k] is not OPEN and not (framed and not page[k].inside) and not page[k].around:
            nearest = labels[k]
        after[k] = nearest
    before, kept = None, []
    for k, block in enumerate(page):
        label = labels[k]
        if label is OPEN:
            if framed:
                known = [x for x in (before, after[k]) if x is not None]
                label = GOOD if not known or GOOD in known else BAD
            elif block.heading:
                label = after[k] if after[k] is not None else before
            else:
                label = GOOD if GOOD in (before, after[k]) else BAD
        elif not block.around and not (framed and not block.inside):
            before = label
        if label == GOOD:
            kept.append(block)
    return kept or [b for b, label in zip(page, labels) if label is OPEN]


def main_text(html: str) -> str:
    """The main text of a page, its blocks joined by blank lines; empty if it has none."""
    return "\n\n".join(b.text for b in main_blocks(blocks(html)))


def extract(pages: DataFrame) -> DataFrame:
    """The rows with ``text``, the page's main text, and ``n_chars``, its code points.

    Null html is an empty page, with empty text; an empty table gives no rows; very long pages
    are read whole, in one pass. Pages are independent: nothing is shuffled, repeated rows get
    equal results, and other columns but ``text`` and ``n_chars`` stay.
    """

    @F.pandas_udf("string")
    def text(html: pd.Series) -> pd.Series:
        single_threaded()
        return html.map(main_text)

    return pages.withColumn("text", text(F.coalesce("html", F.lit("")))).withColumn(
        "n_chars", F.char_length("text").cast("bigint")
    )
