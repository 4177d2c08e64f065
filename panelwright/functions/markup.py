"""Text, label/value pairs and links in raw HTML, as native expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelwright.functions.labels import _col

_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
# the usual ones first, as a map is searched in order
_USUAL = ["amp", "lt", "gt", "quot", "apos", "nbsp", "eacute", "egrave", "agrave", "ccedil", "copy"]


@lru_cache(maxsize=1)
def _named() -> str:
    """All named character references of HTML that end in a semicolon, as a text for ``str_to_map``."""
    names = {n[:-1]: c for n, c in html5.items() if n.endswith(";")}
    return "\x01".join(f"{n}\x02{names[n]}" for n in dict.fromkeys([*_USUAL, *sorted(names)]))


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """What ``body`` makes of a value that it names several times, with the value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _character(reference: Column) -> Column:
    """The character of one reference; an unknown one stays as it is."""
    named = F.str_to_map(F.lit(_named()), F.lit("\x01"), F.lit("\x02"))
    body = F.substring(reference, 2, 40)
    number = F.when(
        F.lower(F.substring(body, 1, 2)) == "#x", F.conv(F.regexp_extract(body, "[0-9a-fA-F]+", 0), 16, 10)
    ).when(F.substring(body, 1, 1) == "#", F.regexp_extract(body, "[0-9]+", 0)).cast("int")
    # surrogates and numbers above the last code point name no character
    valid = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
    numeric = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).when(number.isNotNull(), F.lit("\ufffd"))
    return F.coalesce(numeric, named[F.substring_index(body, ";", 1)], reference)


def _decoded(t: Column) -> Column:
    found = F.transform(F.regexp_extract_all(t, F.lit(_REFERENCE), F.lit(0)), _character)
    between = F.split(t, _REFERENCE, -1)
    decoded = F.array_join(F.zip_with(between, F.concat(found, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    return F.when(t.contains("&"), decoded).otherwise(t)


def unescape(text: Column | str) -> Column:
    """Text with its character references decoded, once: numeric ones and all named ones that end in a semicolon."""
    return _once(_col(text), _decoded)


def clean(text: Column | str) -> Column:
    """Unescaped, trimmed text; NULL where nothing is left."""
    return _once(F.trim(unescape(text)), lambda t: F.when(t != "", t))


def first_match(html: Column | str, pattern: str) -> Column:
    """Clean first group of the first match; NULL where nothing matches or the group is empty."""
    found = F.regexp_extract_all(_col(html), F.lit(pattern), F.lit(1))
    return clean(F.get(found, F.lit(0)))


def element_text(html: Column | str, tag: str) -> Column:
    """Leading text of the first ``tag`` element, up to its first child."""
    return first_match(html, rf"<{tag}(?:\s[^>]*)?>([^<]*)")


#: The value of an attribute in a pattern: in either kind of quotes or in none.
VALUE = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""


def unquoted(value: Column | str) -> Column:
    """The value of an attribute without the quotes around it."""
    return F.regexp_replace(_col(value), r"""^(["'])(.*)\1$""", "$2")


def open_tag(tag: str, token: str, attribute: str = "class") -> str:
    """Pattern of an opening tag one of whose class words (or whose id) is ``token``, whatever else it has."""
    values = rf"""(?:"(?:[^"]*\s)?{token}(?:\s[^"]*)?"|'(?:[^']*\s)?{token}(?:\s[^']*)?'|{token}(?=[\s>]))"""
    return rf"<{tag}\b(?=[^>]*\s{attribute}\s*=\s*{values})[^>]*>"


def division(html: Column | str, id: str) -> Column:
    """The first ``div`` of that id with all it contains, without its end tag; NULL if there is none."""
    rest = F.regexp_extract(_col(html), f"(?s){open_tag('div', id, 'id')}.*", 0)
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("n"), F.lit(False).alias("done"))

    def follow(state: Column, part: Column) -> Column:
        depth = state["depth"] + F.when(part.startswith("<div"), 1).when(part.startswith("</div"), -1).otherwise(0)
        return F.when(state["done"], state).otherwise(
            F.struct(depth.alias("depth"), (state["n"] + 1).alias("n"), (depth <= 0).alias("done"))
        )

    def inside(parts: Column) -> Column:
        # the part that holds the end tag also holds what follows it
        n = F.aggregate(parts, start, follow, lambda state: state["n"] - state["done"].cast("int"))
        return F.array_join(F.slice(parts, F.lit(1), n), "")

    return _once(rest, lambda r: F.when(r != "", _once(F.split(r, r"(?=</?div\b)", -1), inside)))


def label_values(html: Column | str, pattern: str) -> Column:
    """Array of (label, value) structs, one per match of a pattern with two groups; each pair is cut out once."""
    pairs = F.regexp_extract_all(_col(html), F.lit(pattern), F.lit(0))
    return F.transform(
        pairs,
        lambda p: F.struct(
            clean(F.regexp_extract(p, pattern, 1)).alias("label"), clean(F.regexp_extract(p, pattern, 2)).alias("value")
        ),
    )


def value_of(pairs: Column | str, label: str) -> Column:
    """Value of a label in an array of pairs: the last one if it is repeated, NULL if absent."""
    hits = F.filter(_col(pairs), lambda p: p["label"] == F.lit(label))
    return F.try_element_at(hits, F.lit(-1))["value"]


# The parts of an absolute URL.
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column | str) -> Column:
    """Lower-case host of an absolute URL, without user and port; empty if there is none."""
    authority = F.regexp_extract(_col(url), _AUTHORITY, 1)
    return F.lower(F.regexp_replace(F.substring_index(authority, "@", -1), r":\d*$", ""))


def in_domain(url: Column | str, domain: str) -> Column:
    """True for URLs on the domain or one of its subdomains."""
    host = host_of(url)
    return (host == F.lit(domain)) | host.endswith("." + domain)


def _without_dots(path: Column) -> Column:
    """Path with its ``.`` and ``..`` segments resolved."""
    segments = F.split(path, "/")
    # a trailing dot segment names a folder, so the result ends with a slash
    folder = F.get(segments, F.size(segments) - 1).isin(".", "..")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
        .otherwise(F.concat(done, F.array(part))),
    )
    return F.concat(F.array_join(kept, "/"), F.when(folder, F.lit("/")).otherwise(F.lit("")))


def absolute_url(base: Column | str, link: Column | str) -> Column:
    """Link resolved against the URL of the page it is on."""
    page, href = _col(base), F.trim(_col(link))
    scheme = F.regexp_extract(page, _SCHEME, 1)
    root = F.concat(scheme, F.lit("://"), F.regexp_extract(page, _AUTHORITY, 1))
    path = F.regexp_extract(page, _PATH, 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(path, r"^(.*/)", 1), F.lit("")), F.lit("/"))
    link_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    link_tail = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    dotted = href.rlike(r"(^|/)\.\.?(/|$|\?|#)")
    rooted = F.when(href.startswith("/"), link_path).otherwise(F.concat(folder, link_path))
    resolved = F.when(dotted, _without_dots(rooted)).otherwise(rooted)
    return (
        F.when(href.rlike(_SCHEME), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href == "", page)
        .when(href.startswith("#"), F.concat(F.regexp_extract(page, r"^([^#]*)", 1), href))
        .when(href.startswith("?"), F.concat(root, path, href))
        .otherwise(F.concat(root, resolved, link_tail))
    )
