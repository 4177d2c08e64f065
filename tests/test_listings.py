from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from panelwright.plans import listings, pages, workbook
from panelwright.registry.pages import listing_page_fields
from panelwright.sources.schemas import LISTING


def _raw(spark):
    def row(province, price, date="5-Nov-18", locality="X", code="V1", year=None, bed=None, baths=None, area=None):
        return (province, price, date, locality, code, year, None, None, None, bed, baths, area)

    return spark.createDataFrame([
        row("BC", "$ 1,200,000", locality="Surrey", code="V1", year="1990", bed="3", area="1,200"),
        row("BC", "$ 800,000", locality="Surrey", code="V2", year="2020", bed="10", area="800"),
        row("AB", "$ 800,000", locality="Banff", code="T1", bed="2"),
        row("AB", "$ 100,000", date="5-Foo-18", locality=None, bed="2", area="1,000"),
        row(None, "$ 1"), row("AB", None), row("AB", "$ 1", date=None),
    ], LISTING)


def test_clean(spark):
    clean = listings.clean_listings(_raw(spark))
    rows = {(r["province"], r["listprice"]): r for r in clean.collect()}
    assert len(rows) == 4
    first = rows["BC", Decimal("1200000.00")]
    assert (first["year_built"], first["Age"], first["Area"], first["PriceperSqft"]) == (1990, 28, 1200.0, 1000.0)
    assert first["monthyr"] == "Nov18" and first["DateAdd"] == dt.date(2018, 11, 5)
    later = rows["BC", Decimal("800000.00")]
    assert (later["year_built"], later["Age"]) == (2018, 0)
    filled = rows["AB", Decimal("800000.00")]
    assert (filled["Area"], filled["year_built"], filled["PriceperSqft"]) == (1000.0, 2018, 800.0)
    assert rows["AB", Decimal("100000.00")]["DateAdd"] is None


def test_reports(spark):
    clean = listings.clean_listings(_raw(spark))
    beds = listings.price_range(clean, "Bed").collect()
    assert [r["Bed"] for r in beds] == ["2", "3", "10"]
    assert (beds[0]["maxprice"], beds[0]["minprice"]) == (Decimal("800000.00"), Decimal("100000.00"))
    top = sorted(map(tuple, listings.most_expensive_localities(clean).collect()))
    assert top == [("Banff", "T1", "AB", 800.0), ("Surrey", "V1", "BC", 1000.0), ("Surrey", "V2", "BC", 1000.0)]
    summary = {r["province"]: r for r in listings.province_summary(clean).collect()}
    assert summary["AB"]["maxprice"] == Decimal("800000.00") and float(summary["AB"]["avgprice"]) == 450000.0
    highest = listings.extreme_listings(clean).collect()
    assert sorted((r["province"], r["maxprice"]) for r in highest) == [("AB", Decimal("800000.00")), ("BC", Decimal("1200000.00"))]
    crossed = listings.extreme_listings(clean, by_value_only=True)
    # the 800,000 listing of the other province has AB's highest price
    assert sorted(r["province"] for r in crossed.collect()) == ["AB", "BC", "BC"]


def test_workbook(spark):
    panel = spark.createDataFrame(
        [("Alberta", "2018-01", "u", 1.0), ("Alberta", "2018-02", "u", 1.0), ("Alberta", "2018-03", "u", 2.0),
         ("Canada", "2018-01", "u", 9.0), ("Alberta", "2017-01", "u", None)],
        "GEO string, REF_DATE string, uom_houseindex string, total_house_land double",
    )
    assert [tuple(r) for r in workbook.distinct_by_unit(panel, 2018).orderBy("GEO").collect()] == [
        (2018, "u", "Alberta", 2), (2018, "u", "Canada", 1)]
    assert sorted(map(tuple, workbook.distinct_by_year(panel, "Alberta").collect())) == [
        (2017, "Alberta", "u", 0), (2018, "Alberta", "u", 2)]
    assert {r["GEO"] for r in workbook.distinct_on_map(panel).collect()} == {"Alberta"}


PAGE = """<html><h1 itemprop="name"><div class="address">
<span>12 Main St</span> <span>Surrey</span> <span>British&nbsp;Columbia</span> <span>V1V</span></div></h1>
<div id="details_info"><div class="price"><span><span>$ 1,200,000</span><span>CAD</span></span></div>
<dl><dt>Taxes</dt><dd>$2 &amp; up</dd></dl><dl><dt>Date Added</dt>
<dd>5-Nov-18</dd></dl><dl><dt>Style</dt><dd>Flat</dd></dl><dl><dt>Basement</dt><dd>Full</dd></dl>
<div class="characteristics-cnt"><ul><li><span>Sqft</span> <strong>1,200</strong></li>
<li><span>Beds</span><strong>3</strong></li></ul></div></div></html>"""


def test_listing_page(spark):
    row = pages.listing_fields(spark.createDataFrame([(7, PAGE), (8, "<html></html>")], "id int, html string")).orderBy("id").collect()
    first = row[0].asDict()
    assert first == {
        "id": 7, "province": "British\u00a0Columbia", "listprice": "$ 1,200,000", "date_added": "5-Nov-18", "locality": "Surrey",
        "postal_code": "V1V", "year_built": None, "taxes": "$2 & up", "Basement": "Full", "Lot_size": None, "Bed": "3",
        "Baths": None, "Area": "1,200",
    }
    assert all(v is None for k, v in row[1].asDict().items() if k != "id")


def test_listings_shown_beside_the_page_do_not_count(spark):
    page = (
        "<h1><div><span>1 Main</span><span></span><span>Qu&eacute;bec</span></div></h1><div id='details_info'><dl><dt>Taxes</dt><dd>$5</dd></dl>"
        "<div><ul><li><span>Beds</span><strong>2</strong></li></ul></div></div><p class='top price big'><span><span>$ 7</span></span></p>"
        "<div class='similar'><dl><dt>Taxes</dt><dd>$9</dd></dl><li><span>Beds</span><strong>8</strong></li></div>"
    )
    row = pages.listing_fields(spark.createDataFrame([(page,)], "html string")).first()
    assert (row["taxes"], row["Bed"], row["listprice"], row["province"], row["locality"]) == ("$5", "2", "$ 7", "Québec", None)


def test_links(spark):
    html = (
        '<div class="inner-right"><a class="t" href="/CA/1.html?a=1&amp;b=2">x</a></div>'
        '<div class="inner-right"> <a href="http://other.org/2">y</a></div>'
        '<ul><li class="next"><a href="?page=3">next</a></li></ul><a href="/skip">z</a>'
    )
    df = spark.createDataFrame([(1, "https://www.example.com/CA/BC.html", html)], "page_id int, url string, html string")
    links = pages.out_links(df, allowed_domain="example.com")
    assert sorted(r["link"] for r in links.collect()) == [
        "https://www.example.com/CA/1.html?a=1&b=2", "https://www.example.com/CA/BC.html?page=3"]
    everything = pages.out_links(df, [pages.ANY_LINK])
    assert everything.count() == 4 and pages.frontier(everything.unionAll(everything)).count() == 4


@pytest.mark.parametrize("text", ["", "no markup at all"])
def test_links_of_plain_text(spark, text):
    df = spark.createDataFrame([(1, "https://a.b/", text)], "page_id int, url string, html string")
    assert pages.out_links(df).count() == 0


def test_new_links_lose_nothing_and_keep_no_stored_page(spark):
    stored = spark.createDataFrame([(f"https://example.com/{i}",) for i in range(0, 3000, 3)] + [(None,)], "url string")
    frontier = spark.createDataFrame([(f"https://example.com/{i}", i) for i in range(3000)] + [(None, -1)], "link string, n int")
    expected = sorted(i for i in range(3000) if i % 3)
    # from a bitmap that tells nearly all links apart to one that tells none
    for bits in (1 << 26, 1 << 12, 8, 1):
        assert sorted(r["n"] for r in pages.new_links(frontier, stored, bits=bits).collect()) == expected
    assert pages.new_links(frontier, stored.limit(0)).count() == 3000
    found = pages.new_links(frontier, stored)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan
    sizes = [len(r["bitmap"]) for r in pages.bitmap_of(stored, bits=1 << 16).collect()]
    assert len(sizes) <= 2 and set(sizes) == {4096}


def test_listing_pages_are_read_by_all_tasks(spark, tmp_path):
    """One file of narrow rows, of which each becomes a page, is not one task."""
    kinds = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    rows = [(i, "a name", f"Brand{i % 5}", "A TYPE", i % 50, 900.0 + i / 4) for i in range(400)] + [(None, None, None, None, None, None)] * 3
    spark.createDataFrame([*rows, rows[7]], kinds).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    found = listing_page_fields(spark, str(tmp_path))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == width > 1 and sum(sizes) == len(rows) + 1 and max(sizes) < 2 * len(rows) / width
    held = found.where("id = 7").collect()
    assert len(held) == 2 and held[0] == held[1] and held[0]["Lot_size"] == "7 acres & more" and held[0]["listprice"] == "$ 901.75"
