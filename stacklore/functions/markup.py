"""Elements of an HTML page, and column functions that read records out of them.

A page is read tag by tag into its elements in document order, each with its extent, parent
and the element after its subtree: an element ends at its own closing tag, siblings are known,
and tags in comments, scripts and quoted values are none. Names are matched in any case,
attribute values with either quotes or none; elements without a closing tag end with the one
around them.

Built-in expressions have no stack, and `aggregate` over tags would copy its state at every
tag, so this is one Arrow pass per page where the page is read; only narrow records leave it.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Elements without content, and those whose content is no markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style")
# Pages whose records are Python objects at a time; a batch may have many more.
PAGES_AT_ONCE = 256

# In a tag, only `=` makes a quote special: title="a > b" goes on, it's does not.
_INSIDE = r"""((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+)"""
_TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|</([a-zA-Z][^\s/>]*+)[^>]*+>|<([a-zA-Z][^\s/>]*+){_INSIDE}>", re.S)
_ATTRIBUTE = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?""")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])|\Z", re.I) for name in RAW}


class Element:
    """One element: `start` and `end` delimit its content, `after` is the index behind its subtree."""

    __slots__ = ("name", "inside", "start", "end", "parent", "index", "after", "page", "_attributes")

    def __init__(self, page: Page, name: str, inside: str, start: int, parent: int):
        self.page, self.name, self.inside, self.start, self.parent = page, name, inside, start, parent
        self.index = len(page.elements)
        self.end, self.after, self._attributes = start, self.index + 1, None

    def attribute(self, name: str) -> str | None:
        if self._attributes is None:
            if name not in self.inside.lower():
                return None
            found = _ATTRIBUTE.findall(self.inside)
            self._attributes = {k.lower(): entities.unescape(v[1:-1] if v[:1] in ("'", '"') and v[-1:] == v[:1] and len(v) > 1 else v)
                                for k, v in found}
        return self._attributes.get(name)

    def classes(self) -> list[str]:
        return (self.attribute("class") or "").split()

    def find_all(self, name: str, css_class: str | None = None) -> Iterator[Element]:
        return self.page.find_all(name, css_class, self.index + 1, self.after)

    def find(self, name: str, css_class: str | None = None) -> Element | None:
        return next(self.find_all(name, css_class), None)

    def sibling(self) -> Element | None:
        """The next element of the same parent."""
        elements = self.page.elements
        after = elements[self.after] if self.after < len(elements) else None
        return after if after is not None and after.parent == self.parent else None

    def pieces(self) -> list[str]:
        """Text between tags and comments, entities decoded; scripts and styles have none."""
        found, at, page = [], self.start, self.page
        if page.html.find("<", at, self.end) < 0:
            return [entities.unescape(page.html[at:self.end])]
        while at < self.end:
            tag = _TAG.search(page.html, at, self.end)
            found.append(entities.unescape(page.html[at:tag.start() if tag else self.end]))
            at = tag.end() if tag else self.end
            if tag and (tag[2] or "").lower() in RAW:
                at = min(self.end, _RAW_END[tag[2].lower()].search(page.html, at).start())
        return found

    def text(self) -> str:
        return "".join(self.pieces()).strip()

    def stripped_text(self) -> str:
        return "".join(p.strip() for p in self.pieces())


class Page:
    """The elements of one page in document order."""

    def __init__(self, html: str):
        self.html, self.elements = html, []
        self.of_name: dict[str, list[int]] = {}  # indexes in order
        elements, open_now, n_open, at = self.elements, [], Counter(), 0
        while tag := _TAG.search(html, at):
            at = tag.end()
            closed, opened, inside = tag.groups()
            if opened:
                name = opened.lower()
                self.of_name.setdefault(name, []).append(len(elements))
                elements.append(Element(self, name, inside, at, open_now[-1] if open_now else -1))
                if name in RAW or (name not in VOID and not inside.endswith("/")):
                    open_now.append(len(elements) - 1)
                    n_open[name] += 1
                    if name in RAW:
                        at = _RAW_END[name].search(html, at).start()
            elif closed:
                name = closed.lower()
                if n_open[name]:
                    while True:
                        last = self._close(open_now.pop(), tag.start())
                        n_open[last] -= 1
                        if last == name:
                            break
        for i in open_now:
            self._close(i, len(html))

    def _close(self, index: int, end: int) -> str:
        element = self.elements[index]
        element.end, element.after = end, len(self.elements)
        return element.name

    def find_all(self, name: str, css_class: str | None = None, start: int = 0, stop: int | None = None) -> Iterator[Element]:
        stop = len(self.elements) if stop is None else stop
        indexes = self.of_name.get(name, ())
        for i in indexes[bisect_left(indexes, start):bisect_left(indexes, stop)]:
            element = self.elements[i]
            if css_class is None or css_class in element.classes():
                yield element

    def find(self, name: str, css_class: str | None = None) -> Element | None:
        return next(self.find_all(name, css_class), None)

    def with_id(self, element_id: str) -> Iterator[Element]:
        return (e for e in self.elements if e.attribute("id") == element_id)


def _read_one(html: str | None, read: Callable[[Page], object]) -> object:
    page = Page(html or "")
    found = read(page)
    # Elements point to their page and it to them: apart, they are freed at once, not when cycles are collected.
    page.elements.clear()
    return found


def read_batch(pages: pa.Array, read: Callable[[Page], object], kind: pa.DataType) -> pa.Array:
    """`read(page)` for every page, few of them as Python objects at a time."""
    slices = [pages.slice(at, PAGES_AT_ONCE) for at in range(0, len(pages), PAGES_AT_ONCE)]
    found = [pa.array([_read_one(html.as_py(), read) for html in part], kind) for part in slices]
    return pa.concat_arrays(found) if found else pa.array([], kind)


def reader(read: Callable[[Page], object], kind: T.DataType) -> Callable[[Column], Column]:
    """A column function giving `read(page)` for every page; NULL pages have no elements."""
    arrow = to_arrow_type(kind)

    def run(pages: pa.Array) -> pa.Array:
        return read_batch(pages, read, arrow)

    return F.arrow_udf(run, kind)


def _attribute(element: Element | None, name: str) -> str | None:
    return None if element is None else element.attribute(name)


def _text(element: Element | None) -> str | None:
    return None if element is None else element.text()


def _inner(element: Element | None, name: str, css_class: str | None = None) -> Element | None:
    return None if element is None else element.find(name, css_class)


def _hrefs(page: Page) -> list[str | None]:
    return [a.attribute("href") for a in page.find_all("a")]


def _menu(page: Page) -> list[str | None] | None:
    items = _inner(page.find("ul", "nav-list"), "ul")
    return None if items is None else [_attribute(li.find("a"), "href") for li in items.find_all("li")]


def _heading(page: Page) -> str | None:
    return _text(_inner(page.find("div", "page-header"), "h1"))


def _next(page: Page) -> dict | None:
    button = page.find("li", "next")
    return None if button is None else {"href": _attribute(button.find("a"), "href")}


def _cards(page: Page) -> list[dict]:
    found = []
    for card in page.find_all("article", "product_pod"):
        anchor, rating = _inner(card.find("h3"), "a"), card.find("p", "star-rating")
        classes = rating.classes() if rating else []
        found.append({
            "title": _attribute(anchor, "title"), "price": _text(card.find("p", "price_color")),
            "rating_word": classes[1] if len(classes) > 1 else None, "href": _attribute(anchor, "href"),
        })
    return found


def _detail(page: Page) -> dict:
    table, stock = page.find("table", "table-striped"), page.find("p", "instock")
    rows = [(_text(tr.find("th")), _text(tr.find("td"))) for tr in table.find_all("tr")] if table else []
    values = dict(rows)
    about = next((s for e in page.with_id("product_description") if (s := e.sibling()) and s.name == "p"), None)
    return {
        "no_table": table is None, "bad_row": any(th is None or td is None for th, td in rows),
        "upc": values.get("UPC"), "reviews": values.get("Number of reviews"), "stock": _text(stock),
        "description": None if about is None else about.stripped_text(),
    }


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _B = T.StringType(), T.BooleanType()

# Targets of all anchors in page order, NULL for an anchor without one.
hrefs = reader(_hrefs, T.ArrayType(_S))
# Targets in the list nested in the navigation list; NULL without that list.
menu_hrefs = reader(_menu, T.ArrayType(_S))
# Heading of a category page.
heading = reader(_heading, _S)
# The next button; NULL without one.
next_button = reader(_next, _struct(href=_S))
# Product cards of a listing page.
cards = reader(_cards, T.ArrayType(_struct(title=_S, price=_S, rating_word=_S, href=_S)))
# Raw fields of a product page.
_DETAIL = _struct(no_table=_B, bad_row=_B, upc=_S, reviews=_S, stock=_S, description=_S)
detail = reader(_detail, _DETAIL)


def _everything(page: Page) -> dict:
    return {"menu_hrefs": _menu(page), "heading": _heading(page), "next_button": _next(page), "cards": _cards(page), "detail": _detail(page)}


# All of the above but `hrefs`, from one reading of the page.
everything = reader(
    _everything,
    _struct(
        menu_hrefs=T.ArrayType(_S), heading=_S, next_button=_struct(href=_S),
        cards=T.ArrayType(_struct(title=_S, price=_S, rating_word=_S, href=_S)), detail=_DETAIL,
    ),
)
