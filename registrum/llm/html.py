"""Main text of HTML pages by block rules in two passes.

Pass 1 decides blocks by where they stand, by stop-word density, length and link
density; inside <article> or <main> a text needs fewer stop words.  Pass 2 gives short
blocks that pass 1 left open the label of the nearest decided neighbour on its side of
<article> and <main>.

Markup is read in one pass of linear time: a search that fails once is not repeated.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GOOD, BAD, OPEN = 1, 0, -1
SHORT = 70
LONG = 200
STOP_HIGH, STOP_LOW = 0.30, 0.15
LINK_HIGH = 0.35

STOP_WORDS = frozenset(
    (
        "a an and are as at be been but by for from had has have he her his i if in into is it its not of on or she that the their them there they this to was we were which will with you "
        "als am an auch auf aus bei das dem den der des die durch ein eine einem einen einer er es für hat ich im in ist mit nach nicht noch oder sich sie sind so über um und uns von vor war wie wir zu zum zur "
        "au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui ma mais me même mes mon ne nos notre nous on ou par pas pour qu que qui sa se ses son sur ta te un une vos votre vous "
        "al como con de del el ella en entre era es esta este fue ha hay la las le lo los más me mi muy no nos o para pero por que se sin sobre son su sus también te un una uno y ya"
    ).split()
)

_RAW = ("script", "style", "noscript", "template", "iframe", "object", "svg", "math", "canvas", "select", "textarea", "button", "title", "head", "audio", "video", "map")
#: their content is text to its closing tag, or to the end of the page
_OPAQUE = ("script", "style", "textarea", "title")
_DROPPED = {x: re.compile(rf"</{x}(?=[\s/>])", re.I) for x in _RAW if x != "head"}
_START = re.compile(r"<(?:!--|!\[CDATA\[|[!?/a-zA-Z])", re.I)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>", re.S)
_PLAIN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>", re.S)
_LINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: elements that may stay unclosed; they hold no others in the stack
_LOOSE = frozenset("p li dt dd tr td th thead tbody tfoot option optgroup".split())
_AWAY = frozenset("nav footer aside form header menu dialog fieldset".split())
_CLASS = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adslot sponsor sponsored promo promotion banner sidebar side aside widget menu nav navbar navigation breadcrumb breadcrumbs header masthead topbar "
    "footer bottom copyright legal cookie cookies consent notice notices alert gdpr privacy popup modal overlay newsletter subscribe subscription signup login form search comment comments reply replies discussion disqus "
    "related recommended share sharing social toolbar pagination pager skip hidden complementary contentinfo navigation tags toc".split()
)
_SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[^\W\d_]+")


def _away(tag: str, attributes: str) -> bool:
    if tag in _AWAY:
        return True
    for value in _CLASS.findall(attributes) if attributes else ():
        if not _NAMES.isdisjoint(x.lower() for x in _SPLIT.split(value)):
            return True
    return bool(attributes) and re.search(r"\bhidden\b(?!-)|aria-hidden\s*=\s*.?true|display\s*:\s*none", attributes, re.I) is not None


def _tokens(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, closing, attributes) of comments, sections, elements without text (name '') and tags."""
    pos, last = 0, page.rfind(">")
    section, quotes = True, True
    unclosed: set[str] = set()
    while m := _START.search(page, pos):
        at = m.start()
        if m[0] == "<!--":
            end = page.find("-->", m.end())
            pos = end + 3 if end >= 0 else len(page)
            yield at, pos, "", False, ""
            continue
        if len(m[0]) > 4 and section:
            end = page.find("]]>", m.end())
            if end >= 0:
                pos = end + 3
                yield at, pos, "", False, ""
                continue
            section = False
        if at > last:
            return
        t = _TAG.match(page, at) if quotes else None
        if t is None:
            if quotes and m[0][1].isalpha():
                # a quotation mark stays open to the end: from here on they mean nothing
                quotes = False
            t = _PLAIN.match(page, at)
        pos = t.end() if t else page.find(">", at) + 1
        name = t[2].lower() if t else ""
        if name in _DROPPED:
            # self-closed, or without a closing tag, only the tag is dropped
            if not t[1] and not t[3].endswith("/") and name not in unclosed:
                close = _DROPPED[name].search(page, pos)
                if close:
                    end = page.find(">", close.end())
                    pos = end + 1 if end >= 0 else len(page)
                elif name in _OPAQUE:
                    pos = len(page)
                else:
                    unclosed.add(name)
            name = ""
        yield at, pos, name, bool(t and t[1]), t[3] if t else ""


def blocks(page: str) -> Iterator[tuple[str, float, str, bool, bool]]:
    """(text, share of it in links, tag, away, inside an article) in page order; away: in a menu, a footer and so on."""
    stack: list[tuple[str, bool, bool]] = []
    opened: Counter[str] = Counter()
    away = main = loose = False
    tag, links, parts, linked = "", 0, [], 0
    at = 0

    def end() -> tuple[str, float, str, bool, bool] | None:
        text = " ".join(html.unescape("".join(parts)).split())
        return (text, linked / max(1, len(text)), tag, away or loose, main) if text else None

    for start, stop, name, closing, attributes in _tokens(page):
        if start > at:
            parts.append(piece := page[at:start])
            linked += len(piece.strip()) if links else 0
        at = stop
        if not name:
            continue
        if name in _LINE:
            if name == "a":
                links = 0 if closing else 1
            elif name == "br":
                parts.append(" ")
            continue
        got = end()
        if got:
            yield got
        parts, linked, tag, links = [], 0, name, 0
        if name in _LOOSE or name in _VOID:
            loose = False if closing else _away(name, attributes)
            continue
        loose = False
        if closing:
            while opened[name]:
                gone = stack.pop()[0]
                opened[gone] -= 1
                if gone == name:
                    break
            away, main = (stack[-1][1], stack[-1][2]) if stack else (False, False)
            tag = ""
        elif not attributes.endswith("/"):
            # a page's <header> inside its article names the article
            away = away or (_away(name, attributes) and not (name == "header" and main))
            main = main or name in ("article", "main")
            stack.append((name, away, main))
            opened[name] += 1
    if at < len(page):
        parts.append(page[at:])
    got = end()
    if got:
        yield got


def _density(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def label(text: str, link: float, tag: str, away: bool, main: bool) -> int:
    """Pass 1: GOOD, BAD or OPEN."""
    if away:
        return BAD
    if link > LINK_HIGH:
        # a linked paragraph of an article reads like text; a list of links does not
        if main and tag in ("p", "blockquote") and len(text) >= SHORT and _density(text) >= STOP_LOW:
            return OPEN
        return BAD if len(text) > SHORT or link > 0.8 else OPEN
    if len(text) < SHORT or tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
        return OPEN
    density = _density(text)
    if density >= STOP_HIGH or (density >= STOP_LOW and len(text) >= LONG):
        return GOOD
    # <article> and <main> speak for a text that its words do not decide
    if main:
        return GOOD if len(text) >= LONG else OPEN
    return OPEN if density >= STOP_LOW or len(text) >= LONG else BAD


def main_text(page: str | None) -> str:
    """The page's main text, blocks joined by a line feed; empty for a null or empty page."""
    if not page:
        return ""
    found = list(blocks(page))
    labels = [label(*block) for block in found]
    out: list[str | None] = [None] * len(found)
    for side in (True, False):
        _decide(found, labels, [k for k, x in enumerate(found) if x[4] == side], side, out)
    return "\n".join(x for x in out if x is not None)


def _decide(found: list[tuple[str, float, str, bool, bool]], labels: list[int], part: list[int], main: bool, out: list[str | None]) -> None:
    """Pass 2 over the blocks inside, or those outside, of <article> and <main>: the good ones are put into out."""
    if main:
        # a menu inside an article says nothing of its neighbours
        part = [k for k in part if not found[k][3]]
    alone = not main and any(x[4] and not x[3] for x in found)
    decided = [i for i, k in enumerate(part) if labels[k] != OPEN]
    before, ahead = -1, 0
    for i, k in enumerate(part):
        label, block = labels[k], found[k]
        if label != OPEN:
            before = i
        else:
            while ahead < len(decided) and decided[ahead] < i:
                ahead += 1
            after = decided[ahead] if ahead < len(decided) else None
            if before < 0 and after is None:
                # nothing was decided: what has no links is the text, of an article if there is one
                label = GOOD if block[1] <= LINK_HIGH and not alone else BAD
            elif after is None or (before >= 0 and i - before < after - i):
                label = labels[part[before]]
            elif before < 0 or after - i < i - before:
                label = labels[part[after]]
            else:
                # equally near: a heading belongs to what follows it, any other block to what it follows
                label = labels[part[after]] if block[2].startswith("h") else labels[part[before]]
        if label == GOOD:
            out[k] = block[0]


def extracted(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text (main text, empty if none) and n_chars (its code points).

    A null, empty or text-free page has an empty text.  Null ids and urls and repeated rows
    are rows like others.  Text without markup is judged as one block.  Markup that is cut off
    or wrongly nested is read as far as it goes.  Other columns are not read.  No rows give
    no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(page).cast("string").alias("page"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
