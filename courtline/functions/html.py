"""Markup helpers as Column functions: tags cut out of a page's text, attributes, entities.

A page is prepared once by :func:`marked`: comments, declarations, scripts and styles go, tags that
matter are set between two marks and all others become a neutral mark.  What follows is plain
``split`` and ``transform`` work; nothing here runs Python on rows.
"""

from __future__ import annotations

import html.entities

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks around a kept tag, and in place of a dropped one.  These control characters are no text in
#: a page and are removed from it first.
OPEN, CLOSE, GAP = "\u0001", "\u0002", "\u0003"

_ATTRS = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_NO_TAGS = r"(?is)<(?:!--.*?(?:-->|\z)|(script|style)(?=[\s/>])" + _ATTRS + r">.*?(?:</\1\s*>|\z)|![^>]*>|\?[^>]*>)"

#: Python's white space, as str.strip() takes it off
_BLANK = r"(?U)[\s\x1c-\x1f]+"

# The named references come from the standard library's table; numbers 128 to 159 mean Windows-1252.
_NAMED = html.entities.html5
_FREQUENT = ("amp;", "lt;", "gt;", "quot;", "nbsp;")
_WITHOUT_SEMICOLON = sorted((n for n in _NAMED if not n.endswith(";")), key=lambda n: (-len(n), n))


_BUILT: dict[tuple[str, str], Column] = {}


def once(df: DataFrame, name: str, build) -> Column:
    """A long expression over columns of fixed names, built once for an application."""
    key = (df.sparkSession.sparkContext.applicationId, name)
    if key not in _BUILT:
        _BUILT[key] = build()
    return _BUILT[key]


def marked(page: Column, tags: list[str]) -> Column:
    """The page with each start or end tag of ``tags`` between marks.  A tag with an unterminated quote
    is text."""
    kept = rf"(</?(?:{'|'.join(tags)})(?=[\s/>]){_ATTRS}>)"
    marks = F.contains(page, F.lit(OPEN)) | F.contains(page, F.lit(CLOSE)) | F.contains(page, F.lit(GAP))
    text = F.when(marks, F.translate(page, OPEN + CLOSE + GAP, "")).otherwise(page)
    text = F.regexp_replace(text, _NO_TAGS, GAP)
    # of the tags that are not kept the group is empty
    text = F.regexp_replace(text, rf"(?i){kept}|</?[a-z][^\s/>]*{_ATTRS}>", f"{OPEN}$1{CLOSE}")
    return F.replace(text, F.lit(OPEN + CLOSE), F.lit(GAP))


def pieces(text: Column, tags: str, ends: bool = False) -> Column:
    """The text cut before each start tag (with ``ends``: and end tag) that the pattern ``tags`` names."""
    return F.split(text, rf"(?i){OPEN}(?=<{'/?' if ends else ''}(?:{tags})[\s/>])")


def attribute(piece: Column, name: str) -> Column:
    """The value of an attribute of the tag that begins the piece; null without it."""
    value = rf"""(?is)^<[^{CLOSE}]*?[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
    found = F.concat(*(F.regexp_extract(piece, value, i) for i in (1, 2, 3)))
    # most tags have no such attribute
    return F.when(F.regexp_like(piece, F.lit(rf"(?i)^<[^{CLOSE}]*{name}")) & F.regexp_like(piece, F.lit(value)), unescaped(found))


def content(piece: Column) -> Column:
    """What follows the tag that begins the piece."""
    return F.substr(piece, F.locate(CLOSE, piece) + 1)


def until(text: Column, tags: str) -> Column:
    """The text before the next end tag that the pattern ``tags`` names."""
    return F.regexp_replace(text, rf"(?is){OPEN}</(?:{tags})[\s/>].*", "")


def until_cell(text: Column) -> Column:
    """The text before the next end tag of a cell: a plain search for the usual one, a pattern for what is left."""
    return bound(F.substring_index(text, f"{OPEN}</td>{CLOSE}", 1), lambda t: F.when(F.contains(t, F.lit(OPEN)), until(t, "t[dh]")).otherwise(t))


def text_of(marked_text: Column) -> Column:
    """Text without its tags, entities decoded run by run."""
    plain = F.regexp_replace(marked_text, f"{OPEN}[^{CLOSE}]*+{CLOSE}", GAP)
    other = F.contains(marked_text, F.lit(OPEN)) | F.contains(marked_text, F.lit(GAP)) | F.contains(marked_text, F.lit("&"))
    return F.when(other, F.translate(unescaped(plain), GAP, "")).otherwise(marked_text)


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, rf"{_BLANK}$|^{_BLANK}", "")


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    """The value of a key in a constant table, null without one.  The table is one string literal that
    is searched: a map of thousands of entries would weigh on every planning step."""
    table, mark = F.lit(OPEN + OPEN.join(f"{k}{CLOSE}{v}" for k, v in pairs.items()) + OPEN), F.concat(F.lit(OPEN), key, F.lit(CLOSE))
    return bound(F.position(mark, table), lambda at: F.when(at > 0, F.substring_index(F.substr(table, at + F.length(mark), F.lit(64)), OPEN, 1)))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _character(code: Column) -> Column:
    """A code point as text: the replacement character for those that are none, nothing for those that
    are not allowed."""
    windows = {str(i): bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(0x80, 0xA0)}
    allowed = (code >= 0x20) & ((code < 0x7F) | (code > 0x9F)) & ((code < 0xFDD0) | (code > 0xFDEF)) & (code % 65536 < 65534) | code.isin(9, 10, 12)
    return (F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), "�").when(code == 13, "\r")
            .when(code.between(0x80, 0x9F), _lookup(windows, code.cast("string"))).when(~allowed, "").when(code == 0xFEFF, "﻿")
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")))


def _reference(part: Column) -> Column:
    """What followed an ampersand, with the reference it begins with decoded."""
    number = r"^#(?:[xX]0*([0-9a-fA-F]+)|0*([0-9]+));?"
    hexed, plain = F.regexp_extract(part, number, 1), F.regexp_extract(part, number, 2)
    digits = F.when(hexed != "", hexed).otherwise(plain)
    code = F.when(F.length(digits) > 7, 0x110000).when(hexed != "", F.conv(hexed, 16, 10).cast("long")).otherwise(plain.cast("long"))
    name = F.regexp_extract(part, r"^([^\t\n\f <&#;]{1,32};?)", 1)

    def named(n):
        def put(known):
            rest = F.concat(known, part.substr(F.length(n) + 1, F.length(part)))
            return F.when(known.isNotNull(), rest).when(n != "", bound(F.regexp_extract(n, "^(" + "|".join(_WITHOUT_SEMICOLON) + ")", 1), shorter)).otherwise(F.concat(F.lit("&"), part))

        def shorter(prefix):
            return F.when(prefix != "", F.concat(_lookup(_NAMED, prefix), part.substr(F.length(prefix) + 1, F.length(part)))).otherwise(F.concat(F.lit("&"), part))

        return bound(F.coalesce(_lookup({n: _NAMED[n] for n in _FREQUENT}, n), _lookup(_NAMED, n)), put)

    return (F.when(~F.startswith(part, F.lit("#")), bound(name, named))
            .when(F.regexp_like(part, F.lit(number)), F.concat(bound(code, _character), F.regexp_replace(part, number, "")))
            .otherwise(F.concat(F.lit("&"), part)))


def unescaped(text: Column) -> Column:
    """Character references decoded, as the standard library's ``html.unescape`` does."""
    def decoded(t):
        parts = F.split(t, "&")
        # the most frequent reference, if alone, without a look at each
        alone = ~F.contains(F.replace(t, F.lit("&amp;"), F.lit("")), F.lit("&"))
        return F.when(F.contains(t, F.lit("&")) & alone, F.replace(t, F.lit("&amp;"), F.lit("&"))).when(F.contains(t, F.lit("&")), bound(parts, lambda p: F.concat(F.get(p, 0), F.array_join(F.transform(F.slice(p, 2, F.size(p)), _reference), "")))).otherwise(t)

    return bound(text, decoded)
