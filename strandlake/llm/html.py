"""Main text of web pages by block rules in two passes.

A page is cut into blocks at block-level elements. Elements that are beside the text by what they are or are called
(menus, headers, footers, sidebars, notices, adverts, forms and reader comments) are out. The first pass looks at each
other block alone, at its length, the share of its characters in links, and the share of function words among its
words: long enough blocks with function words and few links are good, or near good; others stay open.

The container is the innermost element that holds nearly all the characters of the good blocks. In the second pass an
open block takes the label of its nearest decided neighbours, where the ends of the
container count as good: so headings, lists, references and odd paragraphs of an article stay, whatever element it is
in. Outside of the container, and where too little of it is good, long blocks without function words are bad, and so
are the ends; blocks of links are good only in a named article. Where a page names its article (an article or main element), that is the container.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm.textstats import STOP_WORDS

#: Fixed values of HTML: elements that start a block of their own, and elements without an end.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
SILENT_TAGS = frozenset("head title script style noscript template iframe object svg math canvas audio video select textarea button datalist noembed noframes".split())
#: Elements that may hold the text of a page.
HOLDER_TAGS = frozenset("article main section div center details td".split())
#: Elements whose content is read as characters up to their end tag.
RAW_TAGS = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
ASIDE_TAGS = frozenset("nav footer aside form menu dialog search".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words in class and id names of elements beside the article.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promos promotion banner nav navbar navigation menu menus submenu breadcrumb breadcrumbs sidebar sidebars aside widget widgets footer masthead topbar toolbar header"
    " cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup login paywall share sharing social related recommended recommendations teaser teasers pagination pager skip copyright disclaimer tags".split()
)
#: Those of them that name nothing beside the text where they are within a named article, as an article has tags and references of its own.
OWN_WORDS = frozenset("related recommended recommendations teaser teasers skip copyright disclaimer tags".split())
TALK_WORDS = frozenset("comment comments commentlist disqus reply replies respond discussion".split())
#: An element named so has, or lacks, such a part; it isn't one.
NOT_ASIDE = frozenset("has with without no is js page body site wrapper layout main content".split())

_OPEN = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|/?[a-zA-Z])")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
#: What ends a tag, or begins a quoted value in it: a quote elsewhere than behind = is a character like others.
_MARK = re.compile(r">|=\s*+[\"']")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_ANCHOR = re.compile(r"<(/?)a(?=[\s/>])", re.I)
_TOKEN = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    """text: cut to single blanks; linked: characters in links; aside: why it is never main text, or ''; inside: in an article; holder: the innermost element that it is in of those that may hold the text, by number; above: the next outer one of each."""

    text: str
    linked: int
    aside: str
    inside: bool
    heading: bool
    holder: int
    above: dict[int, int]
    label: str = ""


def _place(tag: str, attributes: str, place: tuple[str, bool]) -> tuple[str, bool]:
    """What an element makes of (why it is beside the article or '', inside an article)."""
    why, inside = place
    found = {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)} if attributes.strip(" /\t\n") else {}
    names = _TOKEN.findall(f"{found.get('class', '')} {found.get('id', '')}")
    talk = not TALK_WORDS.isdisjoint(names)
    if tag in ("article", "main"):
        if why in ("", "name", "form"):  # a name or a form around the article says nothing of it
            return ("talk" if talk else "", True)
        return place
    if why not in ("", "form"):  # in a form there may be other things beside the text
        return place
    if tag == "form":
        return ("form", inside)
    if tag in ASIDE_TAGS or tag == "header" and not inside or found.get("role", "") in ASIDE_ROLES or "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
        return ("element", inside)
    if tag not in ("html", "body") and talk and NOT_ASIDE.isdisjoint(names):
        return ("talk", inside)
    if tag not in ("html", "body") and not (ASIDE_WORDS - OWN_WORDS if inside else ASIDE_WORDS).isdisjoint(names) and NOT_ASIDE.isdisjoint(names) and not (inside and tag in ("h1", "header")):
        return ("name", inside)
    return place


def _is_link(attributes: str) -> bool:
    """Whether an anchor of these attributes leads anywhere; one with a name or id alone is the target of others."""
    names = {k.lower() for k, _ in _ATTRIBUTE.findall(attributes)}
    return "href" in names or bool(names) and names.isdisjoint(("name", "id"))


class _Entry:
    """An open element: what was so before it, and for a block-level one its number and the inline elements open in it."""

    __slots__ = ("tag", "place", "block", "holder", "inline")

    def __init__(self, tag: str, place: tuple[str, bool], block: bool, holder: int) -> None:
        self.tag, self.place, self.block, self.holder, self.inline = tag, place, block, holder, Counter()


def _tag_end(html: str, at: int, dead: set[int]) -> int:
    """Where the > is that ends a tag, with its quoted values; -1 if a value has no end or all > are in values.

    dead: quotes from which no end was found. One that is met outside of values begins one whenever it is, so that no part of a page is looked through in vain again.
    """
    seen = []
    while mark := _MARK.search(html, at):
        if mark[0] == ">":
            return mark.start()
        k = mark.end() - 1
        seen.append(k)
        at = 0 if k in dead else html.find(html[k], k + 1) + 1
        if not at:
            break
    dead.update(seen)
    return -1


def _tokens(html: str) -> Iterator[tuple[str, str, str, int]]:
    """(kind, name, content, end) of pieces of text ("text"), starts ("<") and ends ("/") of elements. send() a place to go on from there."""
    at, n = 0, len(html)
    dead: set[int] = set()
    while at < n:
        found = _OPEN.search(html, at)
        start = found.start() if found else n
        if start > at:
            yield "text", "", html[at:start], start
        if not found:
            return
        what = found[0]
        if what == "<!--":
            end = html.find("-->", start + 2)
            at = n if end < 0 else end + 3
            continue
        if what == "<![CDATA[":
            end = html.find("]]>", start)
            yield "text", "", html[start + 9 : n if end < 0 else end], n if end < 0 else end + 3
            at = n if end < 0 else end + 3
            continue
        if what in ("<!", "<?"):
            end = html.find(">", start)
            at = n if end < 0 else end + 1
            continue
        name = _NAME.match(html, start)
        end = _tag_end(html, name.end(), dead)
        if end < 0:  # what a stray quote would take for a value is read plainly
            end = html.find(">", name.end())
        if end < 0:
            return  # a tag that is not closed ends with the page
        attributes, at = html[name.end() : end], end + 1
        further = yield "/" if name[1] else "<", name[2].lower(), attributes, at
        if further is not None:
            at = further


def blocks(html: str) -> list[Block]:
    """The blocks of a page that have text, in their order."""
    out: list[Block] = []
    parts: list[str] = []
    linked, links = 0, 0
    loose, depth = False, 0  # of the open link: whether its end tag is missing, and the stack where it began
    place, heading = ("", False), False
    root = _Entry("", place, True, 0)
    stack, levels, opened, numbers = [root], [0], Counter(), 1  # levels: where the open block-level elements are
    endless: set[str] = set()  # elements that no end tag follows
    above: dict[int, int] = {}

    def close() -> None:
        nonlocal linked, links, heading
        text = _SPACE.sub(" ", unescape("".join(parts))).strip() if parts else ""
        if text:
            out.append(Block(text, min(linked, len(text)), place[0], place[1], heading, stack[levels[-1]].holder, above))
        parts.clear()
        linked, heading = 0, False
        if loose:
            links = 0

    def pop(k: int) -> None:
        """Ends the elements from place k of the stack on."""
        nonlocal place, links
        place = stack[k].place
        while len(stack) > k:
            entry = stack.pop()
            if entry.block:
                levels.pop()
                opened[entry.tag] -= 1
            elif levels[-1] < len(stack):
                stack[levels[-1]].inline[entry.tag] -= 1
        if len(stack) < depth:
            links = 0

    tokens = _tokens(html)
    token = next(tokens, None)
    while token is not None:
        kind, tag, content, at = token
        goto = None
        if kind == "text":
            parts.append(content)
            if links:
                linked += len(content.strip())
        elif kind == "/":
            if tag == "a":
                links = max(0, links - 1)
            if tag in BLOCK_TAGS:
                close()
                if opened[tag] > 0:
                    k = next(k for k in reversed(levels) if stack[k].tag == tag)
                    pop(k)
            elif stack[levels[-1]].inline[tag] > 0:
                k = len(stack) - 1
                while stack[k].tag != tag:
                    k -= 1
                if stack[k].place != place:
                    close()
                pop(k)
        elif tag in SILENT_TAGS or tag in RAW_TAGS:
            if not content.endswith("/"):
                end = None if tag in endless else re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
                if end:
                    goto = end.end()
                elif tag in RAW_TAGS:
                    goto = len(html)
                elif tag == "head":
                    body = re.compile(r"<body[\s>]", re.I).search(html, at)
                    goto = body.start() if body else None
                if not end:
                    endless.add(tag)
            parts.append(" ")
        else:
            if tag == "a":
                links, depth = int(_is_link(content)), len(stack)
                end = _ANCHOR.search(html, at) if links else None
                loose = not end or not end[1]
            elif tag == "br":
                parts.append("\n")
            block = tag in BLOCK_TAGS
            if block:
                close()
                last = stack[levels[-1]]
                if last.tag == "p" or last.tag == tag and tag in ("li", "dt", "dd", "td", "th", "option"):
                    pop(levels[-1])
                heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6")
            if tag not in VOID_TAGS:
                new = _place(tag, content, place) if block or content.strip() else place
                if new != place and parts:
                    close()
                holder = stack[levels[-1]].holder
                if block and tag in HOLDER_TAGS:
                    above[numbers] = holder
                    holder = numbers
                stack.append(_Entry(tag, place, block, holder))
                numbers += 1
                if block:
                    levels.append(len(stack) - 1)
                    opened[tag] += 1
                else:
                    stack[levels[-1]].inline[tag] += 1
                place = new
        try:
            token = tokens.send(goto)
        except StopIteration:
            token = None
    close()
    return out


def container(found: list[Block], most: float = 0.8) -> tuple[set[int], bool]:
    """The innermost element with this share of the characters of good blocks, with those in it, and whether a quarter of its text or more is good; 0 is the whole page."""
    good, live = Counter(), Counter()
    for b in found:
        if b.label != "out":
            live[b.holder] += len(b.text)
            if b.label in ("good", "near"):
                good[b.holder] += len(b.text)
    total, above = sum(good.values()), found[0].above if found else {}
    numbers = sorted(above)  # elements are numbered as they begin, so that an outer one comes before those in it
    for n in reversed(numbers):
        good[above[n]] += good[n]
        live[above[n]] += live[n]
    inside = [n for n in numbers if good[n] >= most * total]
    if not total or not inside:
        return {0, *numbers}, False
    best = max(inside)  # of those with most of the text one is in the other
    within = {best}
    for n in numbers:
        if above[n] in within:
            within.add(n)
    return within, 4 * good[best] > live[best]


def classify(found: list[Block], *, short: int = 70, long: int = 200, low: float = 0.15, high: float = 0.25, most_linked: float = 0.33) -> list[bool]:
    """Whether each block is main text.

    First pass: a block beside the text, or outside of the article where the page names one, is out. One with more
    than `most_linked` of its characters in links is open ("links"), one shorter than `short` too ("short"). A longer
    one is good if at least `high` of its words are function words and it is longer than `long`, near good if it is
    not longer or the share is `low` at least, and else open ("odd"). Second pass: outside of the container (a named
    article, or what container() finds) odd blocks are bad, as those of links are outside of a named article, and the
    ends of the page are too; inside, they stay open and the ends are good. Open blocks, then near good ones, take the
    label of the nearest decided blocks on both sides; where these differ, a short one is good only if a near good block is as near on the bad side, and a
    near good one is good. A heading goes with the next decided block. On a page without any good or near good
    block the odd ones count as near good, as their language may have other function words.
    """
    def alone(b: Block) -> str:
        words = _WORD.findall(b.text.lower())
        share = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
        if b.linked > most_linked * len(b.text):
            return "links"
        if len(b.text) < short:
            return "short"
        if share >= high:
            return "good" if len(b.text) > long else "near"
        return "near" if share >= low else "odd"

    named = any(b.inside and not b.aside for b in found)
    for b in found:
        b.label = "out" if b.aside not in ("", "form") or named and not b.inside else alone(b)
    size = lambda forms: sum(len(b.text) for b in found if b.label in ("good", "near") and (b.aside == "form") == forms)
    if named or size(True) <= size(False):  # a form around most of the text is the page's, not a part beside it
        for b in found:
            if b.aside:
                b.label = "out"
    if not any(b.label in ("good", "near") for b in found):
        for b in found:
            if b.label == "odd":
                b.label = "near"  # of another language, if it is text at all
    holders, mostly = container(found)
    live = [k for k, b in enumerate(found) if b.label != "out"]
    inner = {k for k in live if named or mostly and found[k].holder in holders}
    first = {}
    for k in live:
        label = found[k].label
        bad = label == "links" and not named or label == "odd" and k not in inner
        first[k] = "bad" if bad else "open" if label in ("links", "odd", "short") else label

    def nearest(order: list[int], decided: tuple[str, ...]) -> dict[int, str]:
        last, within, out = "bad", False, {}
        for k in order:
            if (k in inner) != within:  # an end of the container
                within = not within
                last = "good" if within else "bad"
            out[k] = last
            if first[k] in decided:
                last = first[k]
        return out

    for kind in ("open", "near"):
        sure = ("good", "bad") if kind == "near" else ("good", "bad", "near")
        before, after = nearest(live, sure), nearest(live[::-1], sure)
        new = {}
        for k in live:
            if first[k] != kind:
                continue
            sides = {before[k], after[k]}
            if found[k].heading and kind == "open":
                new[k] = "good" if after[k] in ("good", "near") else "bad"
            elif len(sides) == 1:
                (only,) = sides
                new[k] = "good" if only == "near" else only
            else:
                new[k] = "good" if kind == "near" or sides == {"good", "near"} else "bad"
        first |= new
    return [first.get(k) in ("good", "near") for k in range(len(found))]


def main_text(html: str | None) -> tuple[str, int, int]:
    """Main text, the number of its blocks, and the number of all blocks."""
    found = blocks(html) if html else []
    kept = [b.text for b, good in zip(found, classify(found), strict=True) if good]
    return "\n\n".join(kept), len(kept), len(found)


def _extract(pages: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in pages:
        yield pd.DataFrame([main_text(x) for x in batch], columns=["text", "n_blocks", "n_all_blocks"])


def extract(html: Column) -> Column:
    """A struct of text, n_blocks and n_all_blocks of a whole page."""
    return F.pandas_udf(_extract, "text string, n_blocks int, n_all_blocks int")(html)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of each row, and the counts of blocks kept and found.

    A null or empty page, and one of markup only, has an empty text. Markup that is not closed ends with the page.
    Repeated rows stay; further columns play no part; an empty table gives no rows.
    """
    found = pages.select("page_id", "url", extract(F.col("html")).alias("e"))
    return found.select("page_id", "url", "e.text", F.length("e.text").cast("long").alias("n_chars"), "e.n_blocks", "e.n_all_blocks")


#: What the rules come to where a page has one article element of h1 and p blocks, with four kinds of references.
ORACLE = r"""
WITH a AS (SELECT page_id, url, regexp_extract(html, '<article>(.*)</article>', 1, 's') AS body FROM pages),
b AS (SELECT page_id, url, list_filter(list_transform(regexp_split_to_array(body, '</?(?:p|h1)>'),
  lambda x: trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(replace(x, '<br>', ' '), '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;', '&'), '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks FROM a)
SELECT page_id, url, array_to_string(blocks, chr(10) || chr(10)) AS text, length(array_to_string(blocks, chr(10) || chr(10)))::BIGINT AS n_chars FROM b"""
