"""Pages as element trees, and selectors over them, as table functions for DataFrames and SQL.

    SELECT p.page_id, l.* FROM pages p, LATERAL html_links(p.html) l
    SELECT p.page_id, s.text FROM pages p, LATERAL html_select(p.html, 'article > p:first-child') s

A page is read by the standard library's tokenizer, a state machine that knows quoted,
single-quoted and bare attributes, comments, scripts and entities. Elements close as
browsers close them where end tags are left out (paragraphs, list items, table cells); an end tag without a
start is skipped, elements left open end with the page. One page is held at a time; texts are cut from it where asked for.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What an opening tag ends, unless one of the elements of ``HOLDS`` lies between.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    **dict.fromkeys("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split(), {"p"}),
}
HOLDS = frozenset("html body table ul ol dl select div article section nav td th blockquote".split())
HIDDEN = frozenset(["script", "style"])


@dataclass
class Element:
    tag: str
    attrs: dict[str, str]
    parent: int
    nth: int  # among its parent's elements, from 1
    start: int  # of its text among the page's pieces
    end: int = -1
    children: int = 0
    own: list[str] = field(default_factory=list)  # of scripts and styles, which are no text of the page


class Page(HTMLParser):
    """The elements of a page in the order of their start tags."""

    def __init__(self, text: str) -> None:
        super().__init__(convert_charrefs=True)
        self.elements = [Element("", {}, -1, 1, 0)]
        self.open, self.pieces = [0], []
        self.feed(text)
        self.close()

    def _close(self, upto: int) -> None:
        """Close the open elements above a place."""
        while len(self.open) > upto:
            e = self.elements[self.open.pop()]
            e.end = len(self.pieces)
            if e.tag not in INLINE:
                self.pieces.append("")

    def handle_starttag(self, tag: str, attrs: list) -> None:
        ended = ENDS.get(tag)
        if ended:
            for at in range(len(self.open) - 1, 0, -1):
                name = self.elements[self.open[at]].tag
                if name in ended:
                    self._close(at)
                    if tag not in ("tr",):
                        break
                elif name in HOLDS and name != "td" and name != "th":
                    break
        parent = self.open[-1]
        self.elements[parent].children += 1
        kept: dict[str, str] = {}
        for k, v in attrs:
            kept.setdefault(k, v or "")
        if tag not in INLINE:
            self.pieces.append("")
        self.elements.append(Element(tag, kept, parent, self.elements[parent].children, len(self.pieces), len(self.pieces)))
        if tag not in VOID:
            self.open.append(len(self.elements) - 1)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.elements[self.open[-1]].tag == tag:
            self._close(len(self.open) - 1)

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.elements[self.open[at]].tag == tag:
                self._close(at)
                return

    def handle_data(self, data: str) -> None:
        e = self.elements[self.open[-1]]
        (e.own if e.tag in HIDDEN else self.pieces).append(data)

    def close(self) -> None:
        super().close()
        self._close(1)

    def text(self, i: int) -> str:
        """An element's text, blanks collapsed; block elements part words, inline ones do not."""
        e = self.elements[i]
        return re.sub(r"[\s\xa0]+", " ", "".join(p or " " for p in (e.own if e.tag in HIDDEN else self.pieces[e.start : e.end]))).strip()


INLINE = frozenset("img input wbr a abbr b bdi bdo cite code data dfn em font i kbd label mark q s samp small span strong sub sup time tt u var".split())
_PART = re.compile(r"""(?P<tag>[A-Za-z][\w-]*|\*)|\#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)|\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[~^$*|]?=)\s*(?:"(?P<q>[^"]*)"|'(?P<s>[^']*)'|(?P<bare>[^\]\s]+))\s*)?\]|:(?P<pseudo>first-child|last-child|nth-child\((?P<nth>\d+)\))""")
_STEP = re.compile(r"\s*([>+~]|\s|$)\s*")


@functools.lru_cache(maxsize=256)
def selector(text: str) -> list[list[tuple[str, list]]]:
    """Comma-separated chains of (combinator, tests); raises ValueError for what it does not know."""
    chains = []
    for one in re.split(r",(?![^\[]*\])", text):
        one, at, how, chain = one.strip(), 0, " ", []
        while at < len(one):
            tests = []
            while at < len(one) and (m := _PART.match(one, at)):
                tests.append(m.groupdict())
                at = m.end()
            step = _STEP.match(one, at)
            if not tests or not step:
                raise ValueError(f"selector: {text!r}")
            chain.append((how, tests))
            at, how = step.end(), (step[1].strip() or " ")
        if not chain or how != " ":
            raise ValueError(f"selector: {text!r}")
        chains.append(chain)
    return chains


def _fits(page: Page, i: int, tests: list) -> bool:
    e = page.elements[i]
    for t in tests:
        if t["tag"]:
            if t["tag"] != "*" and t["tag"].lower() != e.tag:
                return False
        elif t["id"]:
            if e.attrs.get("id") != t["id"]:
                return False
        elif t["cls"]:
            if t["cls"] not in e.attrs.get("class", "").split():
                return False
        elif t["attr"]:
            have, op = e.attrs.get(t["attr"].lower()), t["op"]
            want = next((t[k] for k in ("q", "s", "bare") if t[k] is not None), "")
            if have is None or (op == "=" and have != want) or (op == "^=" and not (want and have.startswith(want))) or (op == "$=" and not (want and have.endswith(want))):
                return False
            if (op == "*=" and not (want and want in have)) or (op == "~=" and want not in have.split()) or (op == "|=" and have != want and not have.startswith(want + "-")):
                return False
        elif t["pseudo"]:
            last = page.elements[e.parent].children
            if e.nth != (1 if t["pseudo"] == "first-child" else last if t["pseudo"] == "last-child" else int(t["nth"])):
                return False
    return True


def _matches(page: Page, i: int, chain: list, k: int, before: dict) -> bool:
    """Whether an element ends the first k + 1 steps of a chain."""
    if i <= 0:
        return False
    key = (id(chain), i, k)
    if key not in before:
        how, tests = chain[k]
        found = _fits(page, i, tests)
        if found and k:
            e = page.elements[i]
            if how == ">":
                found = _matches(page, e.parent, chain, k - 1, before)
            elif how == " ":
                up = e.parent
                while up > 0 and not _matches(page, up, chain, k - 1, before):
                    up = page.elements[up].parent
                found = up > 0
            else:
                near = [j for j in range(i - 1, e.parent, -1) if page.elements[j].parent == e.parent]
                found = any(_matches(page, j, chain, k - 1, before) for j in (near[:1] if how == "+" else near))
        before[key] = found
    return before[key]


def select(text: str | None, chosen: str) -> Iterator[tuple[int, str, dict[str, str], str]]:
    """seq, tag, attributes and text of the elements that a selector chooses, in the page's order."""
    if text is None:
        return
    chains, page, before = selector(chosen), Page(text), {}
    seq = 0
    for i in range(1, len(page.elements)):
        if any(_matches(page, i, c, len(c) - 1, before) for c in chains):
            yield seq, page.elements[i].tag, page.elements[i].attrs, page.text(i)
            seq += 1


@F.udtf(returnType="seq int, tag string, attrs map<string,string>, text string")
class HtmlSelect:
    """Elements that a selector chooses; none of a null page."""

    def eval(self, page: str, chosen: str):
        yield from select(page, chosen)


@F.udtf(returnType="seq int, href string, label string")
class HtmlLinks:
    """Anchors with an address: their address as it is written, entities decoded, and their text."""

    def eval(self, page: str):
        for seq, _, attrs, text in select(page, "a[href]"):
            yield seq, attrs["href"].strip(), text


def register(spark: SparkSession) -> list[str]:
    """``html_select`` and ``html_links`` for ``spark.sql``."""
    spark.udtf.register("html_select", HtmlSelect)
    spark.udtf.register("html_links", HtmlLinks)
    return ["html_select", "html_links"]


def chosen(pages: DataFrame, page: str, css: str) -> DataFrame:
    """pages with a row for each element that the selector chooses: seq, tag, attrs, text."""
    selector(css)
    return pages.lateralJoin(HtmlSelect(F.col(page).outer(), F.lit(css)))


def links(pages: DataFrame, page: str) -> DataFrame:
    """pages with a row for each anchor: seq, href, label."""
    return pages.lateralJoin(HtmlLinks(F.col(page).outer()))

