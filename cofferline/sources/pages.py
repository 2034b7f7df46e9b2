"""Account and portfolio rows from stored HTML pages.

The tables to read sit in messy markup, so a tolerant tag parser walks each page; Spark spreads
the pages over tasks and leaves out, before Python sees them, pages that hold no table at all.
Pages all of whose tags are plainly written are cut at their tags by one pattern instead, which gives
the same rows in a fraction of the time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cofferline import schemas
from cofferline.functions.text import contract_from_link, last_path_segment, links_in_html

# The id of the portfolio table, and the number of cells both tables have.
PORTFOLIO_TABLE_ID = "js-chain-table"
CELLS = 6

_ROWS_PER_BATCH = 10_000
_RAW = "page_id long, url string, row_no int, cells array<string>, links array<string>"

# plainly written markup: no stray signs, so that a tag is what stands between < and >
_PIECE = 1 << 18  # characters of a page that are cut at their tags together
_SPACE = r"[\t\n\r\f ]"
_FIELD = rf"""([a-zA-Z_:][a-zA-Z0-9_:.-]*+)(?:{_SPACE}*+=(?:{_SPACE}*+)("[^"<]*+"|'[^'<]*+'|[^\s"'<>=`/]++))?+"""
_FIELDS = re.compile(_FIELD)
_TAG = re.compile(
    rf"<(?:td>([^<]*+)</td>|(/?[a-zA-Z][a-zA-Z0-9:_-]*+)((?:{_SPACE}++{_FIELD.replace('([', '(?:[').replace('("', '(?:"')})*+{_SPACE}*+/?+)>"
    r"|!--[^<>]*-->|![dD][oO][cC][tT][yY][pP][eE][^<>]*>)"
)
_TEXT_ONLY = ("script", "style", "title")  # read here where they hold no tags
_ODD = ("textarea", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext", "math", "svg")
_KINDS = {f"{slash}{name}": f"{slash}{name}" for name in ("table", "tbody", "tr", "td", "a", *_TEXT_ONLY) for slash in ("", "/")}
_KINDS |= {name: "odd" for name in _ODD}


class _Table(HTMLParser):
    """Cells (text, first link) by row of the first table, or of the table with an id."""

    def __init__(self, table_id: str | None, body_only: bool):
        super().__init__(convert_charrefs=True)
        self.table_id, self.body_only = table_id, body_only
        self.depth, self.done, self.in_body, self.bodies = 0, False, not body_only, 0
        self.rows: list[list[list]] = []
        self.cell: list | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            named = self.table_id is None or dict(attrs).get("id") == self.table_id
            if self.depth or (named and not self.done):
                self.depth += 1
            return
        if not self.depth:
            return
        if tag == "tbody" and self.body_only and self.depth == 1:
            self.bodies += 1
            self.in_body = self.bodies == 1  # rows of later bodies are not read
        elif tag == "tr" and self.in_body:
            self.rows.append([])
            self.cell = None
        elif tag == "td" and self.in_body and self.rows:
            self.cell = ["", None]
            self.rows[-1].append(self.cell)
        elif tag == "a" and self.cell is not None and self.cell[1] is None:
            self.cell[1] = dict(attrs).get("href")

    def handle_endtag(self, tag):
        if not self.depth:
            return
        if tag == "table":
            self.depth -= 1
            self.done = self.done or not self.depth
        elif tag == "tbody" and self.body_only and self.depth == 1:
            self.in_body = False
        elif tag in ("td", "tr"):
            self.cell = None

    def handle_data(self, data):
        if self.depth and self.cell is not None:
            self.cell[0] += data


def _plain_tags(html: str) -> Iterator[tuple]:
    """(text, name with its slash, attributes, text up to the next tag) of every tag or bare cell. A cell
    has its text alone, a comment no name; all are None at the first tag that is not plainly written."""
    start = 0
    while start < len(html):
        end = html.find("<td", start + _PIECE)  # never inside a bare cell
        end = len(html) if end < 0 else end
        parts = _TAG.split(html[start:end])
        bare = parts[1::4]
        if html.count("<", start, end) != 2 * len(bare) - bare.count(None):
            yield None, None, None, None
            return
        yield from zip(bare, parts[2::4], parts[3::4], parts[4::4])
        start = end


def _field(attributes: str, name: str) -> str | None:
    """Value of an attribute of a plainly written tag, the last of that name."""
    value = None
    for key, text in _FIELDS.findall(attributes):
        if key.lower() == name:
            value = text and unescape(text[1:-1] if text[0] in "\"'" else text)
            if not text:  # no value
                value = None
    return value


def _plain_rows(html: str, table_id: str | None, body_only: bool) -> list[list[list]] | None:
    """What ``_Table`` finds in a page whose tags are plainly written, None for other pages."""
    rows: list[list[list]] = []
    cell, depth, done, in_body, bodies = None, 0, False, not body_only, 0
    text_only = None  # the end of the script, style or title that is open
    for bare, name, attributes, text in _plain_tags(html):
        if bare is not None:
            if text_only:
                return None
            if depth:
                if in_body and rows:
                    rows[-1].append([unescape(bare) if "&" in bare else bare, None])
                elif cell is not None:
                    cell[0] += unescape(bare)
                cell = None
            continue
        kind = _KINDS.get(name)
        if kind is None:
            if name is None and text is None:
                return None
            kind = _KINDS.get(name.lower(), "other") if name else "comment"
        if text_only and (kind != text_only or attributes.strip()):
            return None
        if attributes and (attributes[-1] == "/" if name[0] != "/" else attributes.strip()) and kind != "other":
            return None  # a tag that is its own end, or an end with attributes
        if kind == "other" or kind == "comment":
            pass
        elif kind == "odd":
            return None
        elif kind in _TEXT_ONLY:
            text_only = f"/{kind}"
        elif kind == text_only:
            text_only = None
        elif kind == "table":
            if depth or (not done and (table_id is None or _field(attributes, "id") == table_id)):
                depth += 1
        elif not depth:
            pass
        elif kind == "td":
            if in_body and rows:
                cell = ["", None]
                rows[-1].append(cell)
        elif kind == "/td" or kind == "/tr":
            cell = None
        elif kind == "a":
            if cell is not None and cell[1] is None:
                cell[1] = _field(attributes, "href")
        elif kind == "tr":
            if in_body:
                rows.append([])
                cell = None
        elif kind == "/table":
            depth -= 1
            done = done or not depth
        elif body_only and depth == 1:
            if kind == "tbody":
                bodies += 1
                in_body = bodies == 1  # rows of later bodies are not read
            elif kind == "/tbody":
                in_body = False
        if text and cell is not None and depth:
            cell[0] += unescape(text) if "&" in text and text_only in (None, "/title") else text
    return None if text_only else rows


def _rows_of(html: str, table_id: str | None, body_only: bool) -> list[list[list]]:
    plain = _plain_rows(html, table_id, body_only)
    if plain is not None:
        return plain
    parser = _Table(table_id, body_only)
    parser.feed(html)
    parser.close()
    return parser.rows


def _table_rows(table_id: str | None, body_only: bool, skip: int) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []

        def told() -> pa.RecordBatch:
            columns = list(zip(*found, strict=True))
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.string()))
            names = ["page_id", "url", "row_no", "cells", "links"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for at in range(len(batch)):  # one page at a time, rows in chunks
                page_id, url, html = (column[at].as_py() for column in batch.columns)
                for number, row in enumerate(_rows_of(html, table_id, body_only)[skip:]):
                    found.append((page_id, url, number, [c[0].strip() for c in row], [c[1] for c in row]))
                    if len(found) == _ROWS_PER_BATCH:
                        yield told()
                        found.clear()
        if found:
            yield told()

    return read


def _raw_rows(pages: DataFrame, marker: str, reader: Callable, rejects: Observation | None) -> DataFrame:
    holding = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    rows = holding.filter(F.lower("html").contains(marker)).mapInArrow(reader, _RAW)
    if rejects is not None:
        rows = rows.observe(rejects, F.count("*").alias("rows"), F.count_if(F.size("cells") < CELLS).alias("short_rows"))
    return rows.filter(F.size("cells") >= CELLS)


def extract_accounts(pages: DataFrame, rejects: Observation | None = None) -> DataFrame:
    """Account rows of the first table of each page; its first row is a header.

    Rows with fewer cells than the table has columns are left out; ``rejects`` counts them, and all
    rows, when the result is computed."""
    rows = _raw_rows(pages, "<table", _table_rows(None, False, skip=1), rejects)
    cell = {name: F.col("cells")[i] for i, name in enumerate(schemas.ACCOUNTS.names)}
    cell["owner"] = last_path_segment(F.col("links")[1])
    return rows.select("page_id", "row_no", *[c.alias(name) for name, c in cell.items()])


def extract_portfolios(pages: DataFrame, rejects: Observation | None = None) -> DataFrame:
    """Portfolio rows of each page; the owner is the last part of its address.

    Pages without the portfolio table, or without rows in it, give no rows. Rows with fewer cells than
    the table has columns are left out; ``rejects`` counts them, and all rows.
    """
    rows = _raw_rows(pages, PORTFOLIO_TABLE_ID, _table_rows(PORTFOLIO_TABLE_ID, True, skip=0), rejects)
    address = last_path_segment(F.regexp_extract("url", r"(?s)^[^?#]*", 0))
    names = ["chain", "token", "portfolio_percent", "price", "amount", "value"]
    cell = {name: F.col("cells")[i] for i, name in enumerate(names)}
    cell["owner"] = address
    cell["contract"] = contract_from_link(F.col("links")[1])
    return rows.select(
        "page_id", "row_no", *[cell[name].alias(name) for name in schemas.PORTFOLIOS.names]
    )


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, pos, link, segment, contract) for every link of every page, character references decoded.

    Pages without text give no rows."""
    found = pages.filter("html is not null").select("page_id", links_in_html(F.col("html")).alias("_links"))
    return found.select("page_id", F.posexplode("_links").alias("pos", "link")).select(
        "page_id",
        "pos",
        "link",
        last_path_segment(F.col("link")).alias("segment"),
        contract_from_link(F.col("link")).alias("contract"),
    )
