"""Field extraction from captured HTML pages (H1, H2) over the page's tokens.

Captured pages are not well-formed XML (tags are left open), so XPath functions do not
apply. A page is cut once into an array of tags and texts by a pattern that never backtracks, and
the array is walked with Spark's higher-order functions: the time is linear in the page, also for
markup that is cut off or repeats an open tag. A tag reaches from ``<`` to the next ``>`` and holds no other
``<``. Every step that several later ones read is bound once (``bound``), so Catalyst can't copy it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordlake.functions.scalars import clean_text

# Where the permit page holds the licence and the registry page the name.
LICENSE_LABEL = "License Number:"
LABEL_CLASS = "MoreDetail_ItemCol1"
NAME_TAG = "td"
NAME_ID = "MainContent_BusInfo"
ERROR_MARKER = "Error.aspx"

#: Tags, texts, and what is neither (a lone angle bracket, or a tag that the next one cuts off, is text).
TOKEN = r"<[^<>]*+>|<?[^<>]++|[<>]"
#: Character references as browsers read them, and the text between them.
REFERENCE = r"&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[^\t\n\f <&#;]{1,32}+;?)|[^&]++|&"


def _escape(text: str) -> str:
    """Literal text as a pattern."""
    return re.sub(r"([^0-9A-Za-z])", r"\\\1", text)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once a row, however often ``use`` reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def tokens(html: Column) -> Column:
    """The tags and texts of a page, in order."""
    return F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))


def _is_tag(x: Column, tag: str) -> Column:
    return x.rlike(rf"(?i)^<{_escape(tag)}\b[^<>]*>$")


def _is_end(x: Column, tag: str) -> Column:
    return x.rlike(rf"(?i)^</{_escape(tag)}\s*>$")


def _has_id(x: Column, elem_id: str) -> Column:
    i = _escape(elem_id)
    return x.rlike(rf"(?i)\sid\s*=\s*(?:\"{i}\"|'{i}'|{i}[\s>])")


def _has_class(x: Column, css_class: str) -> Column:
    """A ``class`` attribute that contains ``css_class``, quoted either way or not at all."""
    c = _escape(css_class)
    return x.rlike(rf"(?i)\sclass\s*=\s*(?:\"[^\"]*{c}|'[^']*{c}|[^\s\"'>]*{c})")


def _first(array: Column, test: Callable[[Column], Column]) -> Column:
    """Index (from 0) of the first element that passes; null without one."""
    place = F.array_position(F.transform(array, lambda x: F.coalesce(test(x), F.lit(False))), F.lit(True))
    return bound(place, lambda p: F.when(p > 0, p - 1))


def _before(array: Column, end: Column) -> Column:
    """The elements up to index ``end``; null if that is null."""
    return F.slice(array, F.lit(1), end.cast("int"))


def _after(array: Column, begin: Column) -> Column:
    """The elements from index ``begin`` on; null if that is null."""
    return bound(begin, lambda b: F.slice(array, (b + 1).cast("int"), F.greatest(F.size(array) - b, F.lit(0)).cast("int")))


@cache
def _names() -> str:
    """All named references with their text, as JSON."""
    return json.dumps(html5)


@cache
def _odd_numbers() -> str:
    """What browsers make of numbers that are no characters: those of a code page; 0 and a carriage return."""
    page = {i: bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(0x80, 0xA0)}
    return json.dumps({str(i): x for i, x in {**page, 0: "�", 0x0D: "\r"}.items()})


def _number(token: Column) -> Column:
    """The text of a numeric reference."""
    digits = F.regexp_extract(token, "^&#[xX]?0*([0-9a-fA-F]*)", 1)
    hexadecimal = token.rlike("^&#[xX]")
    n = F.when(F.length(digits) > 8, F.lit(1 << 40)).otherwise(
        F.coalesce(F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10)).cast("long"), F.lit(0)))

    def text(n: Column) -> Column:
        odd = F.from_json(F.lit(_odd_numbers()), "map<string,string>")
        invalid = (n.between(0x1, 0x8) | (n == 0xB) | n.between(0xE, 0x1F) | n.between(0x7F, 0x9F) | n.between(0xFDD0, 0xFDEF)
                   | (n % 0x10000 >= 0xFFFE))
        outside = n.between(0xD800, 0xDFFF) | (n > 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(outside, F.lit(0xFFFD)).otherwise(n)), 8, "0")), "UTF-32")
        return F.coalesce(F.try_element_at(odd, n.cast("string")), F.when(~outside & invalid, F.lit("")).otherwise(char))
    return bound(n, text)


def _named(token: Column) -> Column:
    """The text of a named reference, or of the longest name without a semicolon that it begins with, else the token."""
    names = F.from_json(F.lit(_names()), "map<string,string>")
    longest = max(len(n) for n in html5 if not n.endswith(";"))
    name = F.substr(token, F.lit(2))
    prefix = lambda k: F.when(k < F.length(name), F.concat(F.try_element_at(names, F.substr(name, F.lit(1), k)), F.substr(name, k + 1)))
    begun = F.get(F.filter(F.transform(F.sequence(F.lit(longest), F.lit(2), F.lit(-1)), prefix), lambda x: x.isNotNull()), F.lit(0))
    return F.coalesce(F.try_element_at(names, name), begun, token)


def decoded(text: Column) -> Column:
    """Text with its character references decoded, each place once, as browsers do (numbers, and all names of HTML)."""
    parts = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))
    one = lambda x: F.when(~F.startswith(x, F.lit("&")) | (x == "&"), x).when(F.startswith(x, F.lit("&#")), F.when(x == "&#", x).otherwise(_number(x))).otherwise(_named(x))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(parts, one), "")).otherwise(text)


def inner_text(parts: Column) -> Column:
    """Text of some tokens: a line break is a new line, other tags go, references are decoded."""
    shown = F.transform(parts, lambda x: F.when(_is_tag(x, "br"), F.lit("\n")).when(x.rlike("^<[^<>]*>$"), F.lit("")).otherwise(x))
    return bound(F.array_join(shown, ""), decoded)


def _label_value(page: Column, label: str, css_class: str) -> Column:
    """The cell beside a label among the page's tokens, which hold no white space alone."""
    words = " ".join(label.split()).lower()
    near = lambda x: F.lower(F.trim(F.regexp_replace(x, r"\s+", " "))) == words
    candidates = F.filter(F.transform(page, lambda x, i: F.when((F.length(x) <= 4 * len(words) + 64) & near(x), i)), lambda i: i.isNotNull())
    at = lambda i, k: F.get(page, i + F.lit(k))
    fits = lambda i: (
        _is_tag(at(i, -1), "span") & _is_tag(at(i, -2), "div") & _has_class(at(i, -2), css_class)
        & _is_end(at(i, 1), "span") & _is_end(at(i, 2), "div") & _is_tag(at(i, 3), "div"))
    place = F.get(F.filter(candidates, fits), F.lit(0)) + 4
    cell = lambda rest: _before(rest, _first(rest, lambda x: _is_end(x, "div")))
    span = lambda c: bound(_after(c, _first(c, lambda x: _is_tag(x, "span")) + 1), lambda rest: _before(rest, _first(rest, lambda x: _is_end(x, "span"))))
    return bound(place, lambda p: F.when(p.isNotNull(), bound(_after(page, p), lambda rest: bound(cell(rest), span))))


def label_field(html: Column, label: str = LICENSE_LABEL, css_class: str = LABEL_CLASS) -> Column:
    """(section, value): whether any element has the class, and the text of the cell beside the label (H1)."""
    filled = F.filter(tokens(html), lambda x: x.rlike(r"\S"))

    def field(page: Column) -> Column:
        value = clean_text(inner_text(_label_value(page, label, css_class)))
        return F.struct(F.exists(page, lambda x: _has_class(x, css_class)).alias("section"), value.alias("value"))
    # most pages of other kinds don't name the class anywhere
    named = F.contains(F.lower(html), F.lit(css_class.lower()))
    none = F.struct(F.lit(False).alias("section"), F.lit(None).cast("string").alias("value"))
    return F.when(named, bound(filled, field)).otherwise(none)


def first_line(html: Column, tag: str = NAME_TAG, elem_id: str | None = NAME_ID) -> Column:
    """Inner HTML of the first element, up to its first line break in any form, stripped (H2); null when absent."""
    opens = (lambda x: _is_tag(x, tag) & _has_id(x, elem_id)) if elem_id else (lambda x: _is_tag(x, tag))
    inner = lambda rest: _before(rest, _first(rest, lambda x: _is_end(x, tag)))
    line = lambda c: F.array_join(_before(c, F.coalesce(_first(c, lambda x: _is_tag(x, "br")), F.size(c))), "")
    found = lambda page: bound(_after(page, _first(page, opens) + 1), lambda rest: bound(inner(rest), line))
    return clean_text(bound(tokens(html), found))


def _column(html) -> Column:
    return F.col(html) if isinstance(html, str) else html


def extract_label_value(html, label: str = LICENSE_LABEL, css_class: str = LABEL_CLASS) -> Column:
    """Text of the cell beside a label (H1), white space stripped; null when the label is absent or
    the cell holds no value."""
    return label_field(_column(html), label, css_class)["value"]


def extract_first_line(html, tag: str = NAME_TAG, elem_id: str | None = NAME_ID) -> Column:
    """Inner HTML of an element up to the first line break in any form, stripped (H2); null when absent."""
    return first_line(_column(html), tag, elem_id)
