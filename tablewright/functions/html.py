"""Expressions on page source, and two small scanners for page structure.

Links, text and page attributes are regular expressions the JVM runs. Table rows
and text without given blocks need open/close bookkeeping that an expression
cannot do, so two small scanners walk one page at a time inside ``mapInPandas``.
"""

from __future__ import annotations

import json
import re
from html import unescape
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

HIDDEN = (
    r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
)
HREF = r"""(?is)^<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
LINE_TAGS = "p|br|div|li|ul|ol|tr|table|h[1-6]|article|section|header|footer|nav|title|body|head"

# The standard's references, from the standard library: names that end in a semicolon by their
# first letter, the old names that may stand without one, and what numbers below 160 mean.
NAMED = {letter: {} for letter in sorted({name[0] for name in html5})}
for _name, _chars in html5.items():
    if _name.endswith(";"):
        NAMED[_name[0]][_name[:-1]] = _chars
BARE = sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True)
LOW_CODES = [unescape(f"&#{code};") for code in range(160)]


def visible(html: Column) -> Column:
    """The source without comments, scripts and styles."""
    return F.regexp_replace(html, HIDDEN, "")


def anchors(html: Column) -> Column:
    """The anchor elements in order, each up to its end tag, the next anchor, or the page's end."""
    pieces = F.filter(F.split(visible(html), r"(?i)(?=<a\s)"), lambda p: p.rlike(r"(?i)^<a\s[^>]*>"))
    return F.transform(pieces, lambda p: F.regexp_extract(p, r"(?is)^.*?(?=</a\s*>|\z)", 0))


def decode_entities(c: Column) -> Column:
    """Character references to characters, each decoded once; text without one is untouched.

    Follows the HTML standard as the standard library does: numbers in both bases, all names
    with a semicolon, and the old names also without one.
    """
    named = F.from_json(F.lit(json.dumps(NAMED)), "map<string,map<string,string>>")
    low = F.from_json(F.lit(json.dumps(LOW_CODES)), "array<string>")
    too_large = F.lit(0x110000).cast("bigint")

    def char(code: Column) -> Column:
        plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return (
            F.when(code < 160, F.get(low, code.cast("int")))
            .when((code > 0x10FFFF) | code.between(0xD800, 0xDFFF), F.lit("\ufffd"))
            .when(code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(0xFFFE) == 0xFFFE), F.lit(""))
            .otherwise(plain)
        )

    def decoded(piece: Column) -> Column:
        decimal = F.regexp_extract(piece, r"^&#([0-9]+);?", 1)
        hexadecimal = F.regexp_extract(piece, r"^&#[xX]0*([0-9A-Fa-f]+);?", 1)
        name = F.regexp_extract(piece, r"^&([A-Za-z][A-Za-z0-9]*);", 1)
        bare = F.regexp_extract(piece, f"^&({'|'.join(BARE)})", 1)
        by_name = F.try_element_at(F.try_element_at(named, F.left(name, F.lit(1))), name)
        old = F.try_element_at(F.try_element_at(named, F.left(bare, F.lit(1))), bare)
        after = lambda n: piece.substr(n + 1, F.length(piece))
        number = F.length(F.regexp_extract(piece, r"^&#(?:[0-9]+|[xX][0-9A-Fa-f]+);?", 0))
        return (
            F.when(~piece.startswith("&"), piece)
            .when(decimal != "", F.concat(char(F.coalesce(decimal.try_cast("bigint"), too_large)), after(number)))
            .when(
                hexadecimal != "",
                F.concat(
                    char(F.when(F.length(hexadecimal) > 6, too_large).otherwise(F.conv(hexadecimal, 16, 10).cast("bigint"))),
                    after(number),
                ),
            )
            .when(by_name.isNotNull(), F.concat(by_name, after(F.length(name) + 2)))
            .when(bare != "", F.concat(old, after(F.length(bare) + 1)))
            .otherwise(piece)
        )

    return let(
        c,
        lambda c: F.when(
            F.contains(c, F.lit("&")), F.array_join(F.transform(F.split(c, "(?=&)"), decoded), "")
        ).otherwise(c),
    )


def join_lines(c: Column) -> Column:
    """Blank runs to one blank per line, empty lines dropped, lines joined by an empty line."""
    lines = F.transform(
        F.split(c, r"\n"), lambda line: F.trim(F.regexp_replace(line, r"[\s\u00a0]+", " "))
    )
    return F.array_join(F.filter(lines, lambda line: line != ""), "\n\n")


def tags_to_text(c: Column, line_tags: str = LINE_TAGS) -> Column:
    """Tags out: block tags end a line, the others leave a blank."""
    c = F.regexp_replace(c, r"[\r\n]", " ")
    c = F.regexp_replace(c, rf"(?i)</?(?:{line_tags})(?:\s[^>]*)?/?>", "\n")
    return join_lines(decode_entities(F.regexp_replace(c, r"<[^>]*>", " ")))


def meta_content(html: Column, attribute: str, name: str) -> Column:
    """``content`` of the page's meta element with the given name or http-equiv."""
    element = F.regexp_extract(html, rf"(?is)<meta\s[^>]*{attribute}\s*=\s*[\"']?{name}[\"'\s][^>]*>", 0)
    return F.nullif(F.regexp_extract(element, r"(?is)content\s*=\s*[\"']([^\"']*)[\"']", 1), F.lit(""))


def script_json(html: Column, pattern: str, schema: str) -> Column:
    """A JSON literal a script assigns, parsed; NULL when the page has none."""
    found = F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))
    return F.from_json(found, schema)


# ---- page structure, one page at a time -----------------------------------------

_SKIP = r"<!--.*?(?:-->|$)|<[!?][^>]*>|<(?P<raw>script|style)\b.*?(?:</(?P=raw)\s*>|$)"
_TABLE_TOKEN = re.compile(_SKIP + r"|<(?P<end>/?)(?P<tag>table|tr|td|th|a)\b(?P<attrs>[^>]*)>", re.I | re.S)
_ANY_TOKEN = re.compile(_SKIP + r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9]*)\b(?P<attrs>[^>]*)>", re.I | re.S)
_TAG = re.compile(r"<!--.*?-->|<[^>]*>", re.S)
_HREF = re.compile(r"""href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_CLASS = re.compile(r"""class\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_LINE = frozenset(LINE_TAGS.replace("h[1-6]", "h1|h2|h3|h4|h5|h6").split("|")) | {"para", "literallayout"}


def _attribute(pattern, attrs):
    found = pattern.search(attrs)
    return None if found is None else unescape(next((g for g in found.groups() if g is not None), ""))


def _plain(source):
    return " ".join(unescape(_TAG.sub("", source)).split())


def table_rows(html):
    """Rows of all tables as (table number, [(text, href, is header)]); inner tables' text is theirs alone."""
    rows, tables, count, at = [], [], 0, 0

    def text_until(stop):
        if tables and tables[-1][1] is not None:
            tables[-1][1][0].append(html[at:stop])

    for token in _TABLE_TOKEN.finditer(html or ""):
        text_until(token.start())
        at = token.end()
        tag, end = (token["tag"] or "").lower(), token["end"]
        if tag == "table" and not end:
            count += 1
            tables.append([count, None, None])  # number, open cell, open row
        elif tag == "table" and tables:
            tables.pop()
        elif tag in ("tr", "td", "th") and tables:
            tables[-1][1] = None
            if tag == "tr":
                tables[-1][2] = None if end else []
                if not end:
                    rows.append((tables[-1][0], tables[-1][2]))
            elif not end and tables[-1][2] is not None:
                tables[-1][1] = [[], None, tag == "th"]
                tables[-1][2].append(tables[-1][1])
        elif tag == "a" and not end and tables and tables[-1][1] is not None and tables[-1][1][1] is None:
            tables[-1][1][1] = _attribute(_HREF, token["attrs"])
    return [(n, [(_plain("".join(parts)), href, th) for parts, href, th in cells]) for n, cells in rows]


def text_without(html, exclude):
    """Lines of text outside the excluded tags and ``.classes``; text after such a block stays."""
    pieces, opened, hidden, at = [], [], 0, 0
    html = html or ""
    for token in _ANY_TOKEN.finditer(html):
        if not hidden:
            pieces.append(unescape(html[at : token.start()].replace("\n", " ").replace("\r", " ")))
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        if token["end"]:
            if any(name == tag for name, _ in opened):
                name = None
                while name != tag:
                    name, was_hidden = opened.pop()
                    hidden -= was_hidden
        elif tag not in _VOID and not token["attrs"].endswith("/"):
            classes = (_attribute(_CLASS, token["attrs"]) or "").split()
            hide = tag in exclude or any("." + name in exclude for name in classes)
            opened.append((tag, hide))
            hidden += hide
        if tag in _LINE and not hidden:
            pieces.append("\n")
    if not hidden:
        pieces.append(unescape(html[at:].replace("\n", " ").replace("\r", " ")))
    lines = (" ".join(line.split()) for line in " ".join(pieces).split("\n"))
    return "\n\n".join(line for line in lines if line)
