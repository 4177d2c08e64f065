from __future__ import annotations

import datetime as dt
from decimal import Decimal
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from panelwright.functions import dates, labels, markup, numbers


@pytest.mark.parametrize("label, province", [
    ("Calgary, Alberta", "Alberta"),
    ("Ontario", "Ontario"),
    ("Ottawa-Gatineau, Quebec part, Ontario/Quebec", "Quebec"),
    ("Ottawa-Gatineau, Ontario part, Ontario/Quebec", "Ontario"),
    ("Calgary, Alberta [48825]", "Alberta"),
    ("Alberta", "Alberta"),
    (None, None),
])
def test_province_of(values, label, province):
    assert values(labels.province_of(F.lit(label).cast("string"))) == province


@pytest.mark.parametrize("label, text", [
    ("Calgary, Alberta [48825]", "Calgary, Alberta"), ("Alberta", "Alberta"), ("A [x] b", "A [x] b"),
])
def test_strip_code(values, label, text):
    assert values(labels.strip_code(F.lit(label))) == text


@pytest.mark.parametrize("name, region", [
    ("New%20Brunswick_weather.csv", "New Brunswick"),
    ("file:/data/weather/Yukon_weather.csv", "Yukon"),
    ("Prince Edward Island_weather.csv", "Prince Edward Island"),
    ("A+B_weather.csv", "A+B"),
    ("100%_weather.csv", "100%"),
])
def test_region_of_file(values, name, region):
    assert values(labels.region_of_file(F.lit(name))) == region


def test_periods(values):
    assert values(dates.year_of(F.lit("2018-01"))) == "2018"
    assert values(dates.year_of(F.lit("2018"))) == "2018"
    assert values(dates.month_of(F.lit("2018-01-05"))) == "2018-01"
    assert values(dates.month_number(F.lit("2018-01"))) == 201801
    assert values(dates.calendar_year(F.lit("2018-01"))) == 2018
    assert values(dates.calendar_year(F.lit("nonsense"))) is None
    assert values(dates.is_month(F.lit("Date/Time"))) is False


@pytest.mark.parametrize("text, date", [
    ("5-Nov-18", dt.date(2018, 11, 5)), ("15-Jan-09", dt.date(2009, 1, 15)), ("5-Foo-18", None), ("", None),
])
def test_listing_date(values, text, date):
    assert values(dates.listing_date(F.lit(text))) == date


def test_listing_month(values):
    assert values(dates.listing_month(F.lit("5-Nov-18"))) == "Nov18"


@pytest.mark.parametrize("year, capped", [(None, 2018), ("2020", 2018), ("1990", 1990), ("old", 2018)])
def test_capped_year(values, year, capped):
    assert values(dates.capped_year(F.lit(year).cast("string"), 2018)) == capped


@pytest.mark.parametrize("text, price", [
    ("$ 1,234,000", Decimal("1234000.00")), ("$ 99", Decimal("99.00")), ("$ call", None),
])
def test_price(values, text, price):
    assert values(numbers.price(F.lit(text))) == price


def test_unit_base(values):
    assert values(numbers.scaled_by_base(F.lit(1.5), F.lit("Index, 201612=100"))) == 150.0
    assert values(numbers.scaled_by_base(F.lit(1.5), F.lit("Dollars"))) is None


@pytest.mark.parametrize("value, digits, rounded", [
    (1.015, 2, 1.02), (2.345, 2, 2.35), (-2.345, 2, -2.35), (0.125, 2, 0.13), (1.01499999999999999, 2, 1.02),
    (1e30, 2, 1e30),
])
def test_round_half_up(values, value, digits, rounded):
    assert values(numbers.round_half_up(F.lit(value), digits)) == rounded


def test_monthly_share_and_net_flow(values):
    assert values(numbers.monthly_share(F.lit(0.06))) == 0.01
    assert values(numbers.net_flow(F.lit(5), F.lit(None).cast("int"), F.lit(2))) is None
    assert values(numbers.net_flow(F.lit(5), F.lit(4), F.lit(2))) == 7


def test_pairs_take_the_last_value(spark):
    html = "<dl><dt>Taxes</dt><dd>1</dd></dl><dl><dt>Taxes</dt><dd>2 &amp;lt;</dd></dl>"
    pairs = markup.label_values("html", r"<dt>([^<]*)</dt><dd>([^<]*)")
    row = spark.createDataFrame([(html,)], "html string").select(
        markup.value_of(pairs, "Taxes").alias("taxes"), markup.value_of(pairs, "Beds").alias("beds")
    ).first()
    assert row["taxes"] == "2 &lt;" and row["beds"] is None


PAGES = ["http://a.example.com/b/c/d?x=1#y", "https://a.example.com", "http://a.example.com/x"]
LINKS = [
    "g", "./g", "g/", "/g", "//h.org/z", "?q=1", "#s", "", "../g", "../../../g", "g?x=/../y", "http://o.org/a",
    ".", "..", "mailto:me@x", "/a/./b/../c", "/a/..", "g;x=1/../y", "a.b/c..d",
]


def test_absolute_url_like_the_standard_library(spark):
    cases = [(page, link) for page in PAGES for link in LINKS]
    rows = spark.createDataFrame(cases, "page string, link string").select(
        "page", "link", markup.absolute_url("page", "link").alias("url")
    ).collect()
    assert [r["url"] for r in rows] == [urljoin(r["page"], r["link"]) for r in rows]


def test_domain(values):
    assert values(markup.in_domain(F.lit("http://m.Example.com:80/x"), "example.com"))
    assert values(markup.in_domain(F.lit("http://example.com"), "example.com"))
    assert not values(markup.in_domain(F.lit("http://badexample.com"), "example.com"))
    assert not values(markup.in_domain(F.lit("mailto:me@example.com"), "example.com"))


@pytest.mark.parametrize("text,expected", [
    ("Montr&eacute;al &amp;lt; &#8217;&#x41;&#X1F600;", "Montréal &lt; ’A\U0001f600"),
    ("&NotAName; &amp &#0;&#xD800;&#9999999;", "&NotAName; &amp ���"), ("plain", "plain"), ("", ""), ("&ngE;", "≧̸"),
])
def test_unescape(values, text, expected):
    assert values(markup.unescape(F.lit(text))) == expected


def test_attributes_in_any_form(values):
    tag = markup.open_tag("div", "inner-right")
    for form in ('<div class="inner-right">', "<div id=x class='wide inner-right big'>", "<div class=inner-right>", '<div data-a="1"\nclass = "a inner-right">'):
        assert values(F.lit(form).rlike(f"^{tag}$"))
    for form in ('<div class="inner-rights">', '<div title="inner-right">', '<p class="inner-right">'):
        assert not values(F.lit(form).rlike(tag))
    link = r"<a\s(?:[^>]*?\s)?href\s*=\s*" + markup.VALUE
    for form in ('<a href="/x?a=1">', "<a class=b href='/x?a=1'>", "<a rel='n' href=/x?a=1>"):
        assert values(markup.unquoted(F.regexp_extract(F.lit(form), link, 1))) == "/x?a=1"


def test_division_ends_with_its_own_end(values):
    page = '<div>a</div><div class="k" id="info"><div>1</div>2<div><div>3</div></div></div><div id="other">4</div>'
    assert values(markup.division(F.lit(page), "info")) == '<div class="k" id="info"><div>1</div>2<div><div>3</div></div>'
    assert values(markup.division(F.lit(page), "absent")) is None
    assert values(markup.division(F.lit("<div id=info>open <div>x"), "info")) == "<div id=info>open <div>x"
    assert values(markup.division(F.lit(None).cast("string"), "info")) is None
    wide = "\U0001f3e0" * 3 + "<div\nid='info'>\U0001f3e0\n<div id=info>1</div>\n</div>\U0001f3e0<div id='info'>2</div>"
    assert values(markup.division(F.lit(wide), "info")) == "<div\nid='info'>\U0001f3e0\n<div id=info>1</div>\n"


def test_a_value_named_several_times_is_worked_out_once(spark):
    plan = spark.range(1).select(markup.clean(F.regexp_extract(F.concat(F.lit("a"), "id"), "a(.)", 1)).alias("v"))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(concat") == 1
