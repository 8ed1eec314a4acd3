"""URL and header parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def query_int(url: Column, name: str) -> Column:
    """A query parameter as a whole number, NULL when absent or not a number."""
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(name)).try_cast("bigint")


def path(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("PATH"))


def host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` segments resolved."""
    parts = F.split(path, "/")
    steps = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.least(F.size(done), F.lit(1)))))
        .otherwise(F.concat(done, F.array(part))),
    )
    ends_in_dots = F.element_at(parts, -1).isin(".", "..")
    return F.array_join(F.when(ends_in_dots, F.concat(steps, F.array(F.lit("")))).otherwise(steps), "/")


def absolute(base: Column, href: Column) -> Column:
    """A link target against the page it stands on, merged as RFC 3986 says.

    A target with a scheme stays as it is; an empty one is the page itself, without its fragment.
    """
    site = F.regexp_extract(base, r"^[^:/?#]+:(?://[^/?#]*)?", 0)
    page = F.regexp_extract(base, r"^[^:/?#]+:(?://[^/?#]*)?([^?#]*)", 1)
    query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)?", 1)
    path = F.regexp_extract(href, r"^[^?#]*", 0)
    tail = href.substr(F.length(path) + 1, F.length(href))
    folder = F.regexp_extract(page, r"^.*/", 0)
    folder = F.when(page == "", F.lit("/")).otherwise(folder)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.substring_index(base, ":", 1), F.lit(":"), href))
        .when(path.startswith("/"), F.concat(site, without_dots(path), tail))
        .when(path != "", F.concat(site, without_dots(F.concat(folder, path)), tail))
        .when(tail.startswith("?"), F.concat(site, page, tail))
        .otherwise(F.concat(site, page, query, tail))
    )


def form_encode(c: Column) -> Column:
    """Form encoding with ``~`` plain and ``*`` escaped."""
    return F.replace(
        F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")
    )


def build_url(base: str, params: Sequence[tuple[str, Column]]) -> Column:
    pairs = [F.concat(form_encode(F.lit(k)), F.lit("="), form_encode(v.cast("string"))) for k, v in params]
    return F.concat(F.lit(base), F.concat_ws("&", *pairs))


def redirect_target(c: Column) -> Column:
    """The target of a ``0;URL=`` refresh; any other value is NULL."""
    return F.when(c.startswith("0;URL="), c.substr(F.lit(7), F.length(c)))


def header_value(header: Column) -> Column:
    """The header before its parameters."""
    return F.trim(F.substring_index(header, ";", 1))


def header_param(header: Column, name: str) -> Column:
    """A header parameter, quoted or bare."""
    found = F.regexp_extract(header, rf'(?i);\s*{name}\s*=\s*("[^"]*"|[^;]*)', 1)
    bare = F.regexp_replace(F.trim(found), r'^"|"$', "")
    return F.nullif(bare, F.lit(""))


def extension(filename: Column) -> Column:
    """``.pdf`` of ``a/b.pdf``; a leading dot alone is no extension."""
    return F.when(filename.isNotNull(), F.regexp_extract(filename, r"[^/](\.[^./]+)$", 1))
