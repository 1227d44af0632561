"""Main text of web pages by two passes over their blocks.

The first pass judges each block by its length, its share of stop words and its share of
link text, and leaves short ones undecided.  The second gives an undecided block the label
of its nearest decided neighbour: one of the same article if it stands in an article, and of two at the
same distance the one that is text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.llm.common import pieces

# Elements that start a new block, and those whose content is never main text.
BLOCK = frozenset(
    "address article aside blockquote body canvas caption center col colgroup dd details dialog "
    "dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup "
    "hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style noscript template textarea iframe svg select object math".split())
SELF_CLOSING = frozenset("svg math".split())  # of these, elements that a slash can end
ASIDE = frozenset("nav footer aside menu dialog head title button label fieldset search".split())
SECTION = frozenset("article main section".split())
# Names of page parts, as sites use them in class, id and role, and words that go with them.
PART = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "complementary contentinfo cookie cookies consent disqus footer gdpr masthead menu modal nav navbar "
    "navigation newsletter notice notices pagination popup promo promos promotion related replies share "
    "sharing sidebar siteheader social sponsor sponsors sponsored subscribe toolbar widget widgets".split()
)
BESIDE = frozenset(
    "a area bar block bottom box btn button buttons col column container content desktop fixed float "
    "form global group header holder icons inline inner items left links list main media mobile module "
    "outer page panel post posts primary reply right row secondary section side site slot sticky sub tertiary "
    "the top unit user users wrap wrapper zone".split()
)
# Elements that hold the article, whatever their names say, and names that tell what a page has.
WHOLE = frozenset("html body main article".split())
_HAS = re.compile(r"(?:^|[_-])(?:no|not|has|with|without|hide|show)[_-].*", re.I | re.S)
_SPLIT = re.compile(r"[-_\d]+")

# Frequent function words of four languages.
STOP_WORDS = frozenset(
    "a about after all also an and are as at be been but by can for from had has have he her his "
    "i if in into is it its more no not of on or she so than that the their there they this to "
    "was we were which will with you "
    "aber als am an auch auf aus bei bin das dass dem den der des die durch ein eine einem einen "
    "einer es für hat ich ihr im in ist kann mit nach nicht noch oder sich sie sind so um und von "
    "war wie wir wird zu zum zur "
    "au aux avec ce ces cette comme dans de des du elle en est et il ils je la le les leur mais "
    "ne nous on ou par pas plus pour qu que qui sa se ses son sont sur un une vous "
    "al como con de del el ella en entre era es esta este fue ha hay la las lo los más me mi muy "
    "no o para pero por que se si sin sobre su sus también un una y ya".split()
)

SHORT = 70  # characters below which a block without links is undecided
LONG = 200
LINKED = 0.33  # share of link text from which a block is a menu
DENSE, SPARSE = 0.12, 0.04  # shares of stop words
MOST = 10  # times the undecided text that an aside has to hold to be the main text

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*)")
_STOP = re.compile("[<>\"']")
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[^\W\d_]+")
_HEADING = re.compile(r"h[1-6]")


def is_part(name: str) -> bool:
    """Whether a class, id or role names a page part.

    All of its words have to: "left-sidebar" does, "market-share" and "no-sidebar" do not.
    """
    words = [w for w in _SPLIT.split(_HAS.sub("", name.lower())) if w]
    return any(w in PART for w in words) and all(w in PART or w in BESIDE for w in words)


@dataclass
class Aside:
    """An element whose content is not main text; ``firm`` if that does not depend on its name."""

    firm: bool
    outer: Aside | None
    depth: int
    dense: int = 0  # characters of dense blocks right inside
    holds: bool = False  # the page's main text after all


@dataclass
class Block:
    section: int
    inside: Aside | None
    heading: bool
    parts: list[tuple[str, bool]] = field(default_factory=list)

    def finish(self) -> None:
        """Decode references, turn white space into single spaces."""
        self.text = " ".join(html.unescape("".join(t for t, _ in self.parts)).split())
        linked = "".join(t for t, link in self.parts if link)
        self.linked = len(" ".join(html.unescape(linked).split())) if linked else 0
        self.parts.clear()


class _Reader:
    """Cuts a page into blocks.  Elements that stay open are closed with their parents."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.stack: list[tuple[str, Aside | None, int]] = []  # element, aside around it, section
        self.names: Counter[str] = Counter()  # of open elements
        self.sections = 0
        self.links = 0
        self.block: Block | None = None

    def cut(self) -> None:
        if self.block is not None and self.block.parts:
            self.block.finish()
            if self.block.text:
                self.blocks.append(self.block)
        self.block = None

    def text(self, content: str) -> None:
        if self.block is None:
            if not content.strip():
                return
            _, aside, section = self.stack[-1] if self.stack else ("", None, 0)
            heading = any(_HEADING.fullmatch(name) for name, _, _ in self.stack[-3:])
            self.block = Block(section, aside, heading)
        self.block.parts.append((content, self.links > 0))

    def open(self, name: str, attributes: str) -> None:
        if name in BLOCK:
            self.cut()
            # A block element ends an open paragraph and, of its own kind, an open item.
            if self.stack and self.stack[-1][0] == "p" or name in ("li", "td", "tr", "dd", "dt", "option") and self.stack and self.stack[-1][0] == name:
                self.names[self.stack.pop()[0]] -= 1
        _, aside, section = self.stack[-1] if self.stack else ("", None, 0)
        if name == "a":
            self.links = 1
        if name in VOID:
            return
        hidden, named = self.marked(name, attributes)
        # A header names the page, unless it stands inside the article.
        firm = hidden or name in ASIDE or name == "header" and not section
        if firm or named or name == "form":
            self.cut()
            aside = Aside(firm, aside, aside.depth + 1 if aside else 0)
        elif name not in BLOCK:
            return
        elif name in SECTION:
            self.sections += 1
            section = self.sections
        self.stack.append((name, aside, section))
        self.names[name] += 1

    @staticmethod
    def marked(element: str, attributes: str) -> tuple[bool, bool]:
        """Whether the element is hidden, and whether it has the name of a page part."""
        hidden = named = False
        for m in _ATTRIBUTE.finditer(attributes):
            name, given = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" or name == "aria-hidden" and "=" in m[0]:
                hidden |= given.lower() != "false"
            elif name in ("class", "id", "role") and element not in WHOLE:
                named |= any(map(is_part, given.split()))
        return hidden, named

    def close(self, name: str) -> None:
        if name == "a":
            self.links = 0
        if name not in BLOCK and not any(name == n for n, _, _ in self.stack[-4:]):
            return
        self.cut()
        while self.names[name]:  # without an open element of the name there is nothing to end
            ended = self.stack.pop()[0]
            self.names[ended] -= 1
            if ended == name:
                break


def _tag_end(page: str, start: int, last: dict[str, int]) -> tuple[int, bool]:
    """Where a tag ends, and that it does; else where the next one begins, or the page ends.

    ``last`` has the places of the page's last quotes, which open nothing.
    """
    while found := _STOP.search(page, start):
        at, sign = found.start(), found[0]
        if sign == ">":
            return at + 1, True
        if sign == "<":
            return at, False
        start = at + 1
        before = at - 1
        while page[before].isspace():
            before -= 1
        if page[before] == "=" and at < last[sign]:
            start = page.index(sign, start) + 1
    return len(page), False


def blocks(page: str) -> list[Block]:
    """One pass over the page; a tag that does not end is text."""
    reader, start, n = _Reader(), 0, len(page)
    last = {sign: page.rfind(sign) for sign in "\"'"}
    while start < n:
        at = page.find("<", start)
        if at != start:
            reader.text(page[start : at if at >= 0 else n])
            if at < 0:
                break
        tag = _NAME.match(page, at)
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            start = end + 3 if end >= 0 else n
        elif page.startswith(("<!", "<?"), at):
            end = page.find(">", at)
            start = end + 1 if end >= 0 else n
        elif tag is None:
            reader.text("<")
            start = at + 1
        else:
            start, ends = _tag_end(page, tag.end(), last)
            if not ends:
                reader.text(page[at:start])
                continue
            name, attributes = tag[2].lower(), page[tag.end() : start - 1]
            if tag[1]:
                reader.close(name)
            elif name in RAW:
                if not (name in SELF_CLOSING and attributes.endswith("/")):
                    end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, start)
                    start = end.end() if end else n
            elif name == "br":
                reader.text(" ")
            else:
                reader.open(name, attributes)
    reader.cut()
    return reader.blocks


def judged(block: Block) -> bool | None:
    """First pass, wherever the block stands: main text, not main text, or undecided."""
    length = len(block.text)
    if block.linked > LINKED * length:
        return False
    if "©" in block.text and length < LONG and not block.section:
        return False
    if block.heading or length < SHORT:
        return None
    words = _WORD.findall(block.text.lower())
    share = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if share >= DENSE or length >= LONG and (share >= SPARSE or length >= 2 * LONG):
        return True
    return None


def _around(page: list[Block], first: list[bool | None]) -> None:
    """Marks the asides that hold the main text after all.

    Where all dense text stands in asides, names and forms have misled: the outermost one that is
    not firm, nor inside a firm one, and has dense text of its own is no aside, nor what is around it.  Of several the one
    with the most text.
    """
    inside = [(b, b.inside) for b, label in zip(page, first, strict=True) if label]
    if any(aside is None for _, aside in inside):
        return
    outside = sum(len(b.text) for b, label in zip(page, first, strict=True) if b.inside is None and label is None)
    found: dict[int, Aside] = {}
    for block, aside in inside:
        aside.dense += len(block.text)
        found[id(aside)] = aside
    best = None
    for aside in found.values():
        if best is None or (aside.depth, -aside.dense) < (best.depth, -best.dense):
            outer = aside
            while outer is not None and not outer.firm:
                outer = outer.outer
            best = aside if outer is None else best
    if best is not None and best.dense < MOST * outside:
        return  # a short article beside other parts
    while best is not None:
        best.holds = True
        best = best.outer


def labels(page: list[Block]) -> list[bool]:
    """Second pass: undecided blocks follow their nearest decided neighbour."""
    first = [judged(b) for b in page]
    _around(page, first)
    first = [False if b.inside is not None and not b.inside.holds else x for b, x in zip(page, first, strict=True)]
    n = len(first)

    def sweep(order) -> list[dict[int | None, int]]:
        seen: dict[int | None, int] = {}
        out: list[dict[int | None, int]] = [{}] * n
        for i in order:
            out[i] = {k: seen[k] for k in (page[i].section, None) if k in seen}
            if first[i] is not None:
                seen[page[i].section] = seen[None] = i
        return out

    left, right = sweep(range(n)), sweep(range(n - 1, -1, -1))
    result = []
    for i, label in enumerate(first):
        if label is None:
            near = [s[i].get(page[i].section) for s in (left, right)]
            if near == [None, None] and not page[i].section:
                near = [s[i].get(None) for s in (left, right)]
            near = [j for j in near if j is not None]
            # An article, or a page, of undecided blocks alone is a short text.
            label = first[min(near, key=lambda j: (abs(i - j), not first[j]))] if near else True
        result.append(label)
    return result


def main_text(page: str) -> str:
    found = blocks(page)
    return "\n\n".join(b.text for b, keep in zip(found, labels(found), strict=True) if keep)


def _extract(pages: pa.Array) -> pa.Array:
    out: list[str] = []
    for _, part in pieces(pages):
        out += [main_text(page.decode("utf-8", "replace")) for page in part]
    return pa.array(out, pa.string())


def extract(df: DataFrame, page: str = "html", text: str = "text") -> DataFrame:
    """Add the main text of each whole page.

    Null, empty and text-free pages give an empty text.  Every row is kept, repeated ones
    too; other columns are untouched and a column of the name ``text`` is replaced.  Text
    without any markup is one block.
    """
    call = F.arrow_udf(_extract, "string")
    return df.withColumn(text, call(F.col(f"`{page}`").cast("string")))
