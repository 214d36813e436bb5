"""Fetched HTML pages to one struct of features per page.

The pages are not well-formed, so the XML functions of Spark cannot read them. Each page is
parsed once, by a small helper inside an Arrow-batched task; everything after that is column
expressions on the struct.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape
from itertools import accumulate, chain

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from touchline import fixed, schemas

# HTML elements without content, and what the start of an element ends:
# tag -> (open elements it ends, elements that shield what lies outside them).
_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_SECTIONS = {"tbody", "thead", "tfoot"}
_ENDS = {
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": (_SECTIONS, {"table"}),
    "thead": (_SECTIONS, {"table"}),
    "tfoot": (_SECTIONS, {"table"}),
    "option": ({"option"}, {"select"}),
    "li": ({"li"}, {"ul", "ol", "table"}),
    "p": ({"p"}, {"td", "th", "div", "li", "table"}),
}
_TABLE_PARTS = {"td", "th", "tr", "table"} | _SECTIONS

_TAG = re.compile(r"<(/?)([a-z][^\s/>]*)", re.IGNORECASE)
# A tag without quotes behind its name, as most are.
_PLAIN_TAG = re.compile(r"""<(/?)([a-z][^\s/>"']*)([^>"']*)>""", re.IGNORECASE)
# A tag whose quotes pair up around values without `<` and `>`, no script or style. Nothing in it can be read in
# two ways, and a try that fails ends at the next `<`, so splitting a page by it costs one pass however broken it is.
_SOUND_TAG = re.compile(
    r"""<(?:(/)|(?!script|style))([a-z][^\s/><"']*+)(?=[\s/>])([^<>"']*+(?:(?:"[^"<>]*+"|'[^'<>]*+')[^<>"']*+)*+)>""",
    re.IGNORECASE,
)
_RAW = re.compile(r"<(script|style)\b", re.IGNORECASE)
_RAW_END = {tag: re.compile(f"</{tag}", re.IGNORECASE) for tag in ("script", "style")}
_QUOTE_OR_END = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# Pages and bytes of pages parsed between two batches of output.
_BATCH = 256
_BATCH_BYTES = 8 << 20
# The most bytes of pages that Spark may hand over at once.
_INPUT_BYTES = 256 << 20


class _Markup:
    """The markup of a page, found in one pass forward.

    Yields (start, stop, raw content, is an end tag, tag, what is written in it). Quoted attribute values
    may hold `>`; where quotes do not pair up before the end of the page, the tag ends at the first `>`.
    Every search is either used up by the tag it serves or remembered, so broken pages cost no more
    than sound ones.
    """

    def __init__(self, html):
        self.html = html
        self.last_end = html.rfind(">")
        self.open_quotes = set()  # quotes from which no tag end can be reached

    def _tag_end(self, start):
        """The place of the `>` that ends a tag."""
        at, tried = start, []
        while True:
            found = _QUOTE_OR_END.search(self.html, at)
            if found is None or found.start() in self.open_quotes:
                break
            if found.group() == ">":
                return found.start()
            tried.append(found.start())
            closing = self.html.find(found.group(), found.end())
            if closing < 0:
                break
            at = closing + 1
        self.open_quotes.update(tried)
        return self.html.find(">", start)

    def __iter__(self):
        html, at, last_end = self.html, 0, self.last_end
        plain = _PLAIN_TAG.match
        while (at := html.find("<", at)) >= 0:
            if at < last_end and (tag := plain(html, at)):
                end, name, written = tag.groups()
                name = name.lower()
                if end or not name.startswith(("script", "style")):
                    stop = tag.end()
                    yield at, stop, None, end == "/", name, written
                    at = stop
                    continue
            if html.startswith("<!--", at):
                stop = html.find("-->", at + 4)
                stop = len(html) if stop < 0 else stop + 3
                yield at, stop, None, False, None, ""
                at = stop
                continue
            if at > last_end:  # no tag can end any more; only a comment can still begin
                at = html.find("<!--", at)
                if at < 0:
                    return
                continue
            raw = _RAW.match(html, at)
            if raw:
                start = html.find(">", at) + 1
                tag = raw.group(1).lower()
                end = _RAW_END[tag].search(html, start)
                stop = end.start() if end else len(html)
                yield at, stop, html[start:stop], False, tag, ""
                at = stop
                continue
            tag = _TAG.match(html, at)
            if tag:
                stop = self._tag_end(tag.end())
                yield at, stop + 1, None, bool(tag.group(1)), tag.group(2).lower(), html[tag.end():stop]
                at = stop + 1
            elif html.startswith(("<!", "<?"), at):
                stop = html.find(">", at) + 1
                yield at, stop, None, False, None, ""
                at = stop
            else:
                at += 1


class _Element:
    """An element and what it holds, as ranges over the page's elements and texts."""

    __slots__ = ("tag", "written", "parent", "index", "last", "text_from", "text_to", "_attributes")

    def __init__(self, tag, written, parent, index, text_from):
        self.tag = tag
        self.written = written
        self.parent = parent
        self.index = self.last = index
        self.text_from = self.text_to = text_from
        self._attributes = None

    @property
    def attributes(self):
        """Attribute values by name; read on demand, as few elements are ever asked."""
        if self._attributes is None:
            self._attributes = {}
            for name, *values in _ATTRIBUTE.findall(self.written):
                self._attributes.setdefault(name.lower(), unescape("".join(values)))
        return self._attributes

    def has_class(self, name):
        return name in self.written and name in self.attributes.get("class", "").split()

    def holds(self, other):
        return self.index < other.index <= self.last


class _Page:
    """Elements and texts of a page in document order. No recursion: broken pages nest deeply."""

    def __init__(self, html):
        self.elements, self.by_tag = [], {}
        self.texts, self.owners, self.owned = [], [], None
        self.open, self.open_at = [], {}  # open elements, and for each tag their places among them
        self.indexes = {}  # the places of the elements of a tag
        parts = _SOUND_TAG.split(html)
        if len(parts) // 4 == html.count("<"):  # the page is texts and sound tags, nothing else
            self._read(parts)
        else:
            self._search(html)
        self._close(0)

    def _read(self, parts):
        """A page split into texts and, for each tag between them, end mark, name and what is written in it."""
        stack, texts, owners, lower, start, end = self.open, self.texts, self.owners, {}, self._start, self._end
        pieces = iter(parts)
        for text, ends, tag, written in zip(pieces, pieces, pieces, pieces):
            if text:
                texts.append(unescape(text) if "&" in text else text)
                owners.append(stack[-1].index if stack else -1)
            tag = lower.get(tag) or lower.setdefault(tag, tag.lower())
            if ends:
                end(tag)
            else:
                start(tag, written)
        self._text(parts[-1])

    def _search(self, html):
        """A page of any other kind, searched piece by piece."""
        text_from = 0
        for start, stop, content, end, tag, written in _Markup(html):
            if start > text_from:
                self._text(html[text_from:start])
            text_from = stop
            if content is not None:
                self._start(tag, "")
                self._text(content, raw=True)
            elif tag:
                if end:
                    self._end(tag)
                else:
                    self._start(tag, written)
        self._text(html[text_from:])

    def _text(self, text, raw=False):
        if text:
            owner = self.open[-1].index if self.open else -1
            self.texts.append(unescape(text) if "&" in text and not raw else text)
            self.owners.append(owner)

    def _innermost(self, tags):
        """The place of the innermost open element of some tags, -1 if none is open."""
        found, open_at = -1, self.open_at
        for tag in tags:
            places = open_at.get(tag)
            if places and places[-1] > found:
                found = places[-1]
        return found

    def _start(self, tag, written):
        stack, elements = self.open, self.elements
        if tag in _ENDS and stack:
            ended, shields = _ENDS[tag]
            if stack[-1].tag in ended:  # most often: what ends is the innermost of all
                self._close_last()
            elif stack[-1].tag not in shields:
                depth = self._innermost(ended)
                if depth >= 0 and depth > self._innermost(shields):
                    self._close(depth)
        element = _Element(tag, written, stack[-1] if stack else None, len(elements), len(self.texts))
        elements.append(element)
        if tag in self.by_tag:
            self.by_tag[tag].append(element)
        else:
            self.by_tag[tag] = [element]
        if tag not in _VOID:
            if tag in self.open_at:
                self.open_at[tag].append(len(stack))
            else:
                self.open_at[tag] = [len(stack)]
            stack.append(element)

    def _end(self, tag):
        places = self.open_at.get(tag)
        if not places:
            return
        # A stray end tag inside a cell must not close the table around it. (The tag itself may be among
        # those asked for: it lies no deeper than its own place.)
        depth = places[-1]
        if depth == len(self.open) - 1:  # most often: the innermost of all
            self._close_last()
        elif depth >= self._innermost(("table",) if tag in _TABLE_PARTS else _TABLE_PARTS):
            self._close(depth)

    def _close_last(self):
        """End the innermost open element."""
        element = self.open.pop()
        element.last, element.text_to = len(self.elements) - 1, len(self.texts)
        self.open_at[element.tag].pop()

    def _close(self, depth):
        """End the open elements from a depth on."""
        last, text_to = len(self.elements) - 1, len(self.texts)
        while len(self.open) > depth:
            element = self.open.pop()
            element.last, element.text_to = last, text_to
            self.open_at[element.tag].pop()

    def all(self, tag, class_name=None, within=None):
        """Elements by tag, optionally by class and below an element of another class."""
        found = self.by_tag.get(tag, [])
        if class_name:
            found = [element for element in found if element.has_class(class_name)]
        if within and found:
            found = _held(found, [element for element in self.elements if element.has_class(within)])
        return found

    def below(self, element, tag):
        """The elements of a tag below an element."""
        found = self.by_tag.get(tag)
        if not found:
            return []
        places = self.indexes.get(tag)
        if places is None:  # asked for when the page has been read
            places = self.indexes[tag] = [other.index for other in found]
        first = bisect_right(places, element.index)
        return found[first : bisect_right(places, element.last, first)]

    def text_of(self, element):
        """All texts in and below an element."""
        return self.texts[element.text_from : element.text_to]

    def own_texts(self, element):
        if self.owned is None:  # asked for when the page has been read
            self.owned = {}
            for place, owner in enumerate(self.owners):
                self.owned.setdefault(owner, []).append(place)
        return [self.texts[place] for place in self.owned.get(element.index, [])]

    def inner_texts(self, element):
        """The texts of the elements below an element, without its own."""
        places = range(element.text_from, element.text_to)
        return [self.texts[place] for place in places if self.owners[place] != element.index]


def _held(elements, boxes):
    """The elements that lie in a box; both in document order, swept once."""
    found, last, boxes = [], -1, iter(boxes)
    box = next(boxes, None)
    for element in elements:
        while box is not None and box.index < element.index:
            last, box = max(last, box.last), next(boxes, None)
        if element.index <= last:
            found.append(element)
    return found


def _first(values):
    return next((value for value in values if value is not None), None)


def _options(page, name):
    """The attributes of the options of a select, by the select's name."""
    selects = [select for select in page.all("select") if select.attributes.get("name") == name]
    return [option.attributes for select in selects for option in page.below(select, "option")]


def _row(page, tr):
    cells, texts = page.below(tr, "td"), page.texts
    main = [cell for cell in cells if cell.has_class(fixed.MAIN_LINK_CLASS)]
    links = _held(page.below(tr, "a"), main) if main else []
    return {
        "direct": tr.parent is not None and tr.parent.tag == "tbody",
        "main_href": links[0].attributes.get("href") if links else None,
        "any_href": _first(link.attributes.get("href") for link in links),
        "main_text": _first(text for link in links for text in page.text_of(link)),
        "cells": ["".join(texts[cell.text_from : cell.text_to]).strip() for cell in cells],
    }


def _table(page, table):
    """The body rows of a table; rows of nested tables count as well."""
    rows = _held(page.below(table, "tr"), page.below(table, "tbody"))
    return {"rows": [_row(page, tr) for tr in rows]}


def page_features_of(html: str | None) -> dict:
    """The features of one page, as PAGE_FEATURES lays them out."""
    page = _Page(html or "")
    headings = page.all("h1")
    country = page.all("a", within=fixed.HEADER_CLUB_CLASS)
    flags = page.all("img", fixed.HEADER_FLAG_CLASS)
    worth = page.all("a", fixed.HEADER_VALUE_CLASS)
    labels = page.all("span", fixed.INFO_LABEL_CLASS, fixed.INFO_BOX_CLASS)
    values = page.all("span", fixed.INFO_VALUE_CLASS, fixed.INFO_BOX_CLASS)
    seasons = _options(page, fixed.STATS_SEASON_SELECT)
    return {
        "h1_first": _first(text for h1 in headings for text in page.own_texts(h1)),
        "h1_all": " ".join(text for h1 in headings for text in page.inner_texts(h1)),
        "country_text": _first(text for link in country for text in page.own_texts(link)),
        "country_alt": _first(flag.attributes.get("alt") for flag in flags),
        "competition_season": _first(
            option.get("value") for option in _options(page, fixed.COMPETITION_SEASON_SELECT) if "selected" in option
        ),
        "stats_season": _first(option.get("value") for option in seasons if "selected" in option),
        "season_options": [option["value"] for option in seasons if "value" in option],
        "tables": [_table(page, table) for table in page.all("table", fixed.ITEM_TABLE_CLASS)],
        "info_labels": [text for span in labels for text in page.own_texts(span)],
        "info_values": [" ".join(page.text_of(span)) for span in values],
        "value_parts": [text for link in worth for text in page.inner_texts(link)][:3],
    }


def _check_batches(spark) -> None:
    """Spark cuts what it hands to Python by bytes; a session that does not must say so."""
    limit = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)
    if not 0 < size <= _INPUT_BYTES:
        raise ValueError("set spark.sql.execution.arrow.maxBytesPerBatch to 256m or less: pages are wide rows")


def _parts(batch: pa.RecordBatch, body: str) -> Iterator[pa.RecordBatch]:
    """A batch in parts of few pages and few bytes, a page at least."""
    start, size = 0, 0
    for row, length in enumerate(pc.fill_null(pc.binary_length(batch.column(body)), 0).to_pylist()):
        if row > start and (row - start == _BATCH or size + length > _BATCH_BYTES):
            yield batch.slice(start, row - start)
            start, size = row, 0
        size += length
    yield batch.slice(start)


def _texts(lists: list[list]) -> pa.Array:
    """Lists of texts as one column: Arrow converts one long list many times faster than many short ones."""
    ends = [0, *accumulate(map(len, lists))]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(list(chain.from_iterable(lists)), pa.string()))


def _column(features: list[dict], kind: pa.StructType) -> pa.Array:
    """The features of a batch of pages as one column of `kind`, built field by field."""
    tables = [page["tables"] for page in features]
    per_table = [table["rows"] for table in chain.from_iterable(tables)]
    rows = list(chain.from_iterable(per_table))
    row = kind.field("tables").type.value_type.field("rows").type.value_type
    cells = pa.StructArray.from_arrays([
        _texts([row["cells"] for row in rows]) if field.name == "cells"
        else pa.array([row[field.name] for row in rows], field.type)
        for field in row
    ], names=[field.name for field in row])
    ends = [0, *accumulate(map(len, per_table))]
    listed = pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), cells)], names=["rows"])
    ends = [0, *accumulate(map(len, tables))]
    found = {"tables": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), listed)}
    for field in kind:
        if field.name not in found:
            values = [page[field.name] for page in features]
            found[field.name] = _texts(values) if pa.types.is_list(field.type) else pa.array(values, field.type)
    return pa.StructArray.from_arrays([found[field.name] for field in kind], names=[field.name for field in kind]).cast(kind)


def with_page_features(pages: DataFrame, body: str) -> DataFrame:
    """Replace the page text `body` by its `features` struct; other columns pass through.

    One task per input split, no shuffle. Select only the columns needed before the call,
    and write the result where it is used more than once.
    """
    # Executors get this module by value, so they need no installed copy of the package.
    _check_batches(pages.sparkSession)
    for module in (fixed, sys.modules[__name__]):
        cloudpickle.register_pickle_by_value(module)
    kept = [name for name in pages.columns if name != body]
    struct = T._parse_datatype_string(schemas.PAGE_FEATURES)
    schema = T.StructType([*[pages.schema[name] for name in kept], T.StructField("features", struct)])
    arrow_struct = to_arrow_type(struct)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _parts(whole, body):
                features = [page_features_of(text.as_py()) for text in batch.column(body)]
                columns = [batch.column(name) for name in kept]
                yield pa.RecordBatch.from_arrays(
                    [*columns, _column(features, arrow_struct)], [*kept, "features"]
                )

    return pages.select(*kept, F.col(body)).mapInArrow(parse, schema)
