"""Fields and links of raw pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelwright.plans import pages as p
from panelwright.registry.listings import _RAW
from panelwright.registry.support import derived, plain, read

_FIELDS = {"title": r"<title>([^<]*)", "heading": r"<h1[^>]*>([^<]*)", "lang": r'<html lang="([^"]*)"'}
_NAV = r'<a href="([^"]*)">([^<]*)</a>'
_LABELS = ["/the", "/de", "/En"]


def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "html")
    found = p.page_fields(pages, _FIELDS, _NAV, _LABELS)
    return found.withColumnsRenamed({label: f"nav_{label[1:]}" for label in _LABELS})


def _unescaped(expression: str) -> str:
    for reference, character in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", "\u00a0"), ("&amp;", "&")]:
        expression = f"replace({expression}, '{reference}', '{character}')"
    return f"trim({expression})"


def _found(pattern: str) -> str:
    return _unescaped(f"(regexp_extract_all(html, '{pattern}', 1))[1]")


def _nav(label: str) -> str:
    pairs = f"list_zip(regexp_extract_all(html, '{_NAV}', 1), regexp_extract_all(html, '{_NAV}', 2))"
    return _unescaped(f"(list_filter({pairs}, lambda q: q[1] = '{label}'))[-1][2]")


_PAGE_FIELDS = f"""SELECT page_id, {', '.join(f'{_found(v)} AS {k}' for k, v in _FIELDS.items())},
  {', '.join(f'{_nav(label)} AS "nav_{label[1:]}"' for label in _LABELS)} FROM pages"""


def page_outlinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    links = p.out_links(pages, [p.ANY_LINK], allowed_domain="example.com")
    return links.select("page_id", "link", "host")


_HOST = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"
_OUTLINKS = f"""SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href AS link, {_HOST} AS host
FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1)) AS href FROM pages)
WHERE {_HOST} = 'example.com' OR {_HOST} LIKE '%.example.com'"""


def page_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return p.frontier(p.out_links(pages, [p.ANY_LINK]))


_FRONTIER = """SELECT DISTINCT regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href AS link
FROM (SELECT url, unnest(regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1)) AS href FROM pages)"""

def frontier_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages that links lead to and that are not stored."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return p.new_links(p.frontier(p.out_links(pages, [p.ANY_LINK])), pages.select("url"))


# detail pages of the derived listings; labels of missing values are left out, their order varies
_DETAIL_PAGES = f"""
SELECT id, '<html><h1 class="x"> <div><span>' || id || '</span><span>' || coalesce(locality, '') || '</span> <span>' ||
  coalesce(province, '') || '</span><span>' || postal_code || '</span></div></h1><div id="details_info">' ||
  '<div class="price"><span><span>' || listprice || '</span></span></div>' ||
  CASE WHEN id % 2 = 0 THEN '<dl><dt>Taxes</dt><dd>' || taxes || '</dd></dl><dl><dt>Basement</dt><dd>' || Basement || '</dd></dl>'
       ELSE '<dl><dt>Basement</dt><dd>' || Basement || '</dd></dl><dl><dt>Taxes</dt><dd>' || taxes || '</dd></dl>' END ||
  '<dl><dt> Date Added </dt><dd>' || date_added || '</dd></dl>' ||
  coalesce('<dl><dt>Year Built</dt><dd>' || year_built || '</dd></dl>', '') ||
  '<dl><dt>Lot Size</dt><dd>' || Lot_size || ' &amp; more</dd></dl><div class="characteristics-cnt"><ul>' ||
  coalesce('<li><span>Beds</span> <strong>' || Bed || '</strong></li>', '') ||
  coalesce('<li><span>Baths</span> <strong>' || Baths || '</strong></li>', '') ||
  coalesce('<li><span>Sqft</span> <strong>' || Area || '</strong></li>', '') || '</ul></div></div></html>' AS html
FROM ({_RAW})"""


def listing_page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.listing_fields(derived(spark, sf_dir, _DETAIL_PAGES, long_by_row=True))


_LISTING_PAGE_FIELDS = f"""SELECT id, nullif(trim(province), '') AS province, listprice, date_added,
  nullif(trim(locality), '') AS locality, postal_code, year_built, taxes, "Basement", "Lot_size" || ' & more' AS "Lot_size",
  "Bed", "Baths", "Area" FROM ({plain(_RAW)})"""


QUERIES = {
    "page_fields": (page_fields, _PAGE_FIELDS),
    "page_outlinks": (page_outlinks, _OUTLINKS),
    "page_frontier": (page_frontier, _FRONTIER),
    "frontier_new": (frontier_new, f"{_FRONTIER} EXCEPT SELECT url FROM pages"),
    "listing_page_fields": (listing_page_fields, _LISTING_PAGE_FIELDS),
}
