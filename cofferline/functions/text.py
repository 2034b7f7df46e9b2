"""Column expressions on text: item keys, links, money, list literals."""

from __future__ import annotations

from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The smallest amount the source prints, and the number it stands for.
TINY_TEXT = "<0.000001"
TINY_NUMBER = 0.000001

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_ELEMENT = r"""(?s)'(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+"|[^\s,\[\]'"]++"""
# what holds no tags, then an anchor's attributes, then one of them behind any others
_UNSEEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*+>.*?(?:</\1\s*>|\z)"
_ANCHOR = r"""(?is)<a(?=[\s/])((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>]++)"""
_ATTRIBUTE = (
    r"""(?is)^(?:[\s/]++(?!{name}\s*+=)[^\s=>/"']++(?:\s*+=\s*+""" + _VALUE + r""")?+)*+[\s/]++{name}\s*+=\s*+(""" + _VALUE + ")"
)


def _number(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def amount_number(text: Column, strict: bool = False) -> Column:
    """``1,234.5`` to 1234.5. Other text gives null, or an error when ``strict``."""
    plain = F.regexp_replace(text, ",", "")
    return plain.cast("double") if strict else _number(plain)


def value_number(text: Column, tiny_value: float | None = None) -> Column:
    """``$1,234.5`` to 1234.5; the tiny-value mark becomes ``tiny_value``, other text null."""
    plain = F.regexp_replace(text, r"[$,]", "")
    if tiny_value is None:
        return _number(plain)
    return F.when(F.trim(plain) == TINY_TEXT, F.lit(float(tiny_value))).otherwise(_number(plain))


def item_key(*parts: Column) -> Column:
    """Parts joined by ``_``; null parts are skipped."""
    return F.concat_ws("_", *parts)


def last_path_segment(link: Column) -> Column:
    """Text after the last ``/`` of a link."""
    return F.trim(F.element_at(F.split(link, "/"), -1))


def contract_from_link(link: Column) -> Column:
    """Last path segment up to ``?``; null when there is no link."""
    return F.split_part(last_path_segment(link), F.lit("?"), F.lit(1))


def anchor_tags(html: Column) -> Column:
    """Attribute texts of all anchor start tags in page order. Quoted values may hold any character;
    comments, scripts and styles hold no tags."""
    seen = F.regexp_replace(html, _UNSEEN, " ")
    return F.regexp_extract_all(seen, F.lit(_ANCHOR), F.lit(1))


def attribute(attributes: Column, name: str) -> Column:
    """Value of the first attribute of that name, quoted either way or bare; null without one."""
    value = F.regexp_extract(attributes, _ATTRIBUTE.format(name=name), 1)
    return F.when(value != "", F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2"))


def _decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for lists in batches:
        rows = lists.to_pylist()
        yield pa.array([row and [unescape(x) if "&" in x else x for x in row] for row in rows], pa.list_(pa.string()))


def links_in_html(html: Column) -> Column:
    """All link targets of anchors, in page order: any case, quoted either way or bare, character references
    decoded. Anchors inside comments, scripts and styles do not count."""
    column = F.col(html) if isinstance(html, str) else html
    targets = F.transform(anchor_tags(column), lambda tag: attribute(tag, "href"))
    return F.arrow_udf(_decoded, "array<string>")(F.filter(targets, lambda link: link.isNotNull()))


def list_from_text(text: Column) -> Column:
    """``['a', 'b']`` to an array; a bare string becomes a one-element array.

    Elements without quotes, such as numbers, are kept as their text. Line breaks may stand between
    elements and inside quotes."""
    literals = F.regexp_extract_all(text, F.lit(_ELEMENT), F.lit(0))
    inner = F.transform(
        literals,
        lambda q: F.when(
            q.rlike(r"""^['"]"""), F.regexp_replace(q.substr(F.lit(2), F.length(q) - 2), r"(?s)\\(.)", "$1")
        ).otherwise(q),
    )
    is_literal = F.trim(F.translate(text, "\n\r\t", "   ")).rlike(r"""(?s)^(\[.*\]|'.*'|".*")$""")
    return F.when(is_literal, inner).when(text.isNotNull(), F.array(text))


def text_from_list(items: Column) -> Column:
    """Array to ``['a', 'b']``, the form ``list_from_text`` reads."""
    quoted = F.transform(
        items,
        lambda s: F.concat(
            F.lit("'"), F.regexp_replace(s, r"(['\\])", r"\\$1"), F.lit("'")
        ),
    )
    return F.concat(F.lit("["), F.concat_ws(", ", quoted), F.lit("]"))


def seeded_order(seed: int, *parts: Column) -> Column:
    """Text that sorts rows in a random but repeatable order."""
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))
