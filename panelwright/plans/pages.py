"""Listing fields and links out of stored raw pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions import markup as m
from panelwright.sources.schemas import LISTING

# The markup of a listing page.  Pairs are label and value.
ADDRESS_PART = r'<h1[^>]*>.*?<div[^>]*>(.*?)</div>'
SPAN_TEXT = r"<span[^>]*>([^<]*)"
PRICE = m.open_tag(r"\w+", "price") + r"\s*<span[^>]*>\s*<span[^>]*>([^<]*)"
DETAILS_BLOCK = "details_info"
DETAILS = r"<dt[^>]*>([^<]*)</dt>\s*<dd[^>]*>([^<]*)"
CHARACTERISTICS = r"<li[^>]*>\s*<span[^>]*>([^<]*)</span>\s*<strong[^>]*>([^<]*)"
DETAIL_FIELDS = {
    "date_added": "Date Added",
    "year_built": "Year Built",
    "taxes": "Taxes",
    "Basement": "Basement",
    "Lot_size": "Lot Size",
}
CHARACTERISTIC_FIELDS = {"Bed": "Beds", "Baths": "Baths", "Area": "Sqft"}
# second, third and fourth address part
ADDRESS_FIELDS = {"locality": 1, "province": 2, "postal_code": 3}
ANY_LINK = r"<a\s(?:[^>]*?\s)?href\s*=\s*" + m.VALUE
LISTING_LINK = m.open_tag("div", "inner-right") + r"\s*" + ANY_LINK
NEXT_PAGE_LINK = m.open_tag("li", "next") + r"\s*" + ANY_LINK


def listing_fields(pages: DataFrame, html: str = "html") -> DataFrame:
    """One raw listing row (12 text columns) per stored detail page, other columns kept.

    Labels may come in any order; a missing or empty one gives NULL.  Details and
    characteristics are those of the page's own details block, not of listings
    shown beside it.
    """
    block = m.division(html, DETAILS_BLOCK)
    address = F.regexp_extract_all(
        F.regexp_extract(html, "(?s)" + ADDRESS_PART, 1), F.lit(SPAN_TEXT), F.lit(1)
    )
    parsed = pages.withColumns({
        "_address": F.transform(address, m.clean),
        "_block": block,
    }).withColumns({
        "_details": m.label_values("_block", DETAILS),
        "_traits": m.label_values("_block", CHARACTERISTICS),
    })
    columns = {"listprice": m.first_match(html, PRICE)}
    columns |= {name: F.get("_address", F.lit(i)) for name, i in ADDRESS_FIELDS.items()}
    columns |= {name: m.value_of("_details", label) for name, label in DETAIL_FIELDS.items()}
    columns |= {name: m.value_of("_traits", label) for name, label in CHARACTERISTIC_FIELDS.items()}
    kept = [c for c in pages.columns if c != html]
    return parsed.withColumns(columns).select(*kept, *LISTING.names)


def page_fields(pages: DataFrame, fields: dict[str, str], pair_pattern: str, labels: Sequence[str], html: str = "html") -> DataFrame:
    """Texts found by one-group patterns, and the values of labels among the pairs of a two-group pattern."""
    texts = {name: m.first_match(html, pattern) for name, pattern in fields.items()}
    parsed = pages.withColumns({**texts, "_pairs": m.label_values(html, pair_pattern)})
    values = {label: m.value_of("_pairs", label) for label in labels}
    kept = [c for c in pages.columns if c != html]
    return parsed.withColumns(values).select(*kept, *fields, *labels)


def out_links(
    pages: DataFrame,
    patterns: Sequence[str] = (LISTING_LINK, NEXT_PAGE_LINK),
    allowed_domain: str | None = None,
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """One row per link: the page's columns, ``link`` made absolute, and its ``host``.

    With an allowed domain, links that leave it (and its subdomains) are dropped.
    """
    found = [F.regexp_extract_all(html, F.lit(p), F.lit(1)) for p in patterns]
    links = F.concat(*found) if len(found) > 1 else found[0]
    kept = [c for c in pages.columns if c != html]
    rows = pages.select(*kept, F.explode(links).alias("_href"))
    out = rows.withColumn("link", m.absolute_url(url, m.unescape(m.unquoted("_href")))).drop("_href")
    if allowed_domain is not None:
        out = out.where(m.in_domain("link", allowed_domain))
    return out.withColumn("host", m.host_of("link"))


def frontier(links: DataFrame) -> DataFrame:
    """The distinct pages that the links lead to (a fragment names no page of its own)."""
    return links.select(F.regexp_extract("link", r"^([^#]*)", 1).alias("link")).distinct()


#: Bits of the bitmap of stored pages: 8 MB, whatever the number of pages.
BITMAP_BITS = 1 << 26


def _slot(url: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(bits)) + 1


def bitmap_of(urls: DataFrame, url: str = "url", bits: int = BITMAP_BITS) -> DataFrame:
    """block and bitmap: the hashes of all addresses as set bits, in rows of 4 KB; at most ``bits`` in all."""
    slot = _slot(F.col(url), bits)
    known = urls.where(F.col(url).isNotNull())
    return known.groupBy(F.bitmap_bucket_number(slot).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bitmap")
    )


def new_links(frontier: DataFrame, stored: DataFrame, link: str = "link", url: str = "url", bits: int = BITMAP_BITS) -> DataFrame:
    """The links of a frontier that lead to no stored page.

    A link whose bit is not set in the bitmap of the stored addresses is new;
    that takes no shuffle, the bitmap being of bounded size.  The rest, nearly
    all of them stored, go through an exact anti-join.  ``bits`` should be about
    ten times the stored pages; fewer only send more links to the anti-join.
    NULL links are left out.
    """
    bitmap = F.broadcast(bitmap_of(stored, url, bits))
    slot = _slot(F.col(link), bits)
    probed = frontier.where(F.col(link).isNotNull()).withColumns(
        {"_block": F.bitmap_bucket_number(slot), "_bit": F.bitmap_bit_position(slot)}
    )
    octet = F.conv(F.hex(F.substring(F.col("bitmap"), (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    seen = F.expr("shiftright(_octet, cast(_bit % 8 as int)) & 1") == 1
    looked_up = (
        probed.join(bitmap, F.col("_block") == F.col("block"), "left").withColumn("_octet", octet)
        .withColumn("_seen", F.coalesce(seen, F.lit(False))).select(*frontier.columns, "_seen")
    )
    addresses = stored.select(F.col(url).alias("_url"))
    maybe = looked_up.where("_seen").drop("_seen").join(addresses, F.col(link) == F.col("_url"), "left_anti")
    return looked_up.where("NOT _seen").drop("_seen").unionByName(maybe)
