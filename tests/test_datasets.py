"""The panel sources on small hand-made tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from panelwright.operators.lookups import region_ids
from panelwright.plans import datasets as d
from panelwright.plans.regional_panel import load_all, panel_columns, regional_panel
from panelwright.sources.schemas import PANEL_COLUMNS, RATE_VALUES


def _long(spark, names, rows):
    """Long rows (REF_DATE, GEO, DGUID, categories..., VALUE) with unit 17 and scalar 0."""
    columns = ["REF_DATE", "GEO", "DGUID", *names, "VALUE"]
    schema = ", ".join(f"`{c}` {'double' if c == 'VALUE' else 'string'}" for c in columns)
    return spark.createDataFrame(rows, schema).withColumns({"UOM_ID": F.lit(17), "SCALAR_ID": F.lit(0)})


@pytest.fixture(scope="module")
def codes(spark):
    uom = spark.createDataFrame([(17, "Index, 201612=100 "), (18, "Dollars")], "memberUomCode int, memberUomEn string")
    scalar = spark.createDataFrame([(0, "units "), (3, "thousands")], "scalarFactorCode int, scalarFactorDescEn string")
    return uom, scalar


@pytest.fixture(scope="module")
def housing_long(spark):
    kinds = ["House only", "Land only", "Total (house and land)"]
    rows = [("2018-01", "Calgary, Alberta", "C1", k, v) for k, v in zip(kinds, (1.0, 2.0, 3.0))]
    rows += [("2018-01", " Edmonton, Alberta", "C2", k, v) for k, v in zip(kinds, (3.0, 4.0, None))]
    rows += [("2018-01", "Alberta", "P1", k, 11.0) for k in kinds]
    rows += [("2018-02", "Alberta", "P1", kinds[0], None), ("2018-01", "Ottawa-Gatineau, Quebec part, Ontario/Quebec", "C3", kinds[0], 5.0)]
    return _long(spark, ["New housing price indexes"], rows)


def test_housing(housing_long, codes):
    rows = {r["DGUID"]: r for r in d.housing(housing_long, *codes).collect()}
    assert set(rows) == {"C1", "C2", "P1", "C3"}
    assert (rows["C1"]["house_only"], rows["C1"]["land_only"], rows["C1"]["total_house_land"]) == (1.0, 2.0, 3.0)
    assert rows["C2"]["GEO"] == "Edmonton, Alberta" and rows["C2"]["total_house_land"] is None
    assert (rows["C1"]["uom_houseindex"], rows["C1"]["scalar_houseindex"]) == ("Index, 201612=100", "units")
    provinces = {r["province"]: r for r in d.housing(housing_long, *codes, by="province").collect()}
    assert provinces["Alberta"]["avg_house_only"] == 5.0 and provinces["Quebec"]["avg_house_only"] == 5.0
    without = {r["province"]: r for r in d.housing(housing_long, *codes, by="province", own_rows=False).collect()}
    assert without["Alberta"]["avg_house_only"] == 2.0
    with pytest.raises(ValueError):
        d.housing(housing_long, *codes, by="planet")


def test_income(spark, codes):
    names = ["Sex", "Age group", "Persons with income"]
    rows = [("2018", "Calgary, Alberta", "C1", "Both sexes", "All age groups", m, v)
            for m, v in [(d.INCOME_MEASURE["region"], 12.5), (d.INCOME_MEASURE["province"], 60.0)]]
    rows += [("2018", "Alberta", "P1", "Both sexes", "All age groups", d.INCOME_MEASURE["province"], 40.0),
             ("2018", "Alberta", "P1", "Males", "All age groups", d.INCOME_MEASURE["province"], 99.0)]
    long = _long(spark, names, rows)
    region = d.income(long, *codes).collect()
    assert [(r["DGUID"], r["income"]) for r in region] == [("C1", 12.5)]
    assert region[0]["statistic_income"] == "5-year percent change of median income, Both sexes, All age groups"
    province = d.income(long, *codes, by="province").collect()
    assert [(r["province"], r["avg_income"]) for r in province] == [("Alberta", 50.0)]


def test_expenditure_and_tourism_under_their_own_names(spark):
    column = "Household expenditures, summary-level categories"
    names = {**d.EXPENDITURE, **d.EDUCATION}
    values = {category: float(i) for i, category in enumerate(names)}
    long = _long(spark, [column], [("2017", "Alberta", "P1", c, v) for c, v in values.items()])
    row = d.expenditure(long).first()
    assert {names[c]: v for c, v in values.items()} == {n: row[n] for n in names.values()}
    assert "avg_education" not in d.expenditure(long, by="province").columns
    kinds = [("2018-01", "Calgary, Alberta", "C1", "Total international travellers", 1.0),
             ("2018-01", "Calgary, Alberta", "C1", "Total Canadian residents", 2.0),
             ("2018-01", "Calgary, Alberta", "C1", "Total cars", 9.0)]
    long = _long(spark, ["Traveller characteristics"], kinds)
    row = d.tourism(long).first()
    assert (row["international_tourism"], row["domestic_tourism"]) == (1.0, 2.0)
    assert d.tourism(long, by="province").first()["province"] == "Alberta"


def test_labour_age_groups(spark):
    names = ["Labour force characteristics", "Sex", "Age group", "Statistics", "Data type"]
    rows = [("2018-01", "Alberta", "P1", "Employment", "Both sexes", a, "Estimate", "Seasonally adjusted", v)
            for a, v in (("15 years and over", 30.0), ("25 to 54 years", 10.0))]
    rows += [("2018-01", "Alberta", "P1", "Employment", "Males", "15 years and over", "Estimate", "Seasonally adjusted", 99.0)]
    long = _long(spark, names, rows)
    assert d.labour(long).first()["employment"] == 20.0
    one = d.labour(long, age_group="25 to 54 years").first()
    assert one["employment"] == 10.0 and one["statistic_labourforce"] == "Both sexes, 25 to 54 years, Seasonally adjusted"
    assert "avg_unemploymentrate" in d.labour(long, by="province").columns


def test_crime_labels(spark):
    rows = [("2018", "Calgary, Alberta [48825]", "C1", "Total, all violations", "Actual incidents", 10.0),
            ("2018", "Alberta [48]", "P1", "Total, all violations", "Actual incidents", 30.0),
            ("2018", "Alberta", "P2", "Total, all violations", "Actual incidents", 50.0),
            ("2018", "Alberta [48]", "P1", "Total, all violations", "Rate per 100,000 population", 7.0)]
    long = _long(spark, ["Violations", "Statistics"], rows)
    assert [(r["DGUID"], r["crime_incidents"]) for r in d.crime(long).collect()] == [("P1", 7.0)]
    assert [(r["province"], r["avg_crime_incidents"]) for r in d.crime(long, by="province").collect()] == [("Alberta", 30.0)]


def test_fuel_adds_province_averages_once(spark, housing_long):
    ids = region_ids(housing_long)
    fuel = list(d.FUEL)[0]
    rows = [("2018-01", "Calgary, Alberta", "C1", fuel, 100.0), ("2018-01", "Edmonton, Alberta", "C2", fuel, 120.0),
            ("2018-01", "Ottawa-Gatineau, Quebec part, Ontario/Quebec", "C3", fuel, 90.0)]
    long = _long(spark, ["Type of fuel"], rows)
    out = sorted((r["DGUID"], r["diesel_fillingstations"]) for r in d.fuel(long, ids).collect())
    assert out == [("C1", 100.0), ("C2", 120.0), ("C3", 90.0), ("P1", 110.0)]
    own = long.unionByName(_long(spark, ["Type of fuel"], [("2018-01", "Alberta", "P1", fuel, 50.0)]))
    assert d.fuel(own, ids).where("DGUID = 'P1'").count() == 1
    assert d.fuel(own, ids, keep_duplicates=True).where("DGUID = 'P1'").count() == 2
    provinces = {r["province"]: r["avg_diesel_fillingstations"] for r in d.fuel(long, by="province").collect()}
    assert provinces == {"Alberta": 110.0, "Quebec": 90.0}


@pytest.mark.parametrize("by", ["region", "province"])
def test_panel_has_one_row_per_housing_row(spark, codes, housing_long, by):
    both = ["Both sexes", "15 years and over", "Estimate", "Seasonally adjusted"]
    tables = {
        "housing": housing_long,
        "uom": codes[0],
        "scalar": codes[1],
        "income": _long(spark, ["Sex", "Age group", "Persons with income"],
                        [("2018", "Alberta", "P1", "Both sexes", "All age groups", m, 24.0) for m in d.INCOME_MEASURE.values()]),
        "expenditure": _long(spark, ["Household expenditures, summary-level categories"], [("2018", "Alberta", "P1", "Rent", 120.0)]),
        "tourism": _long(spark, ["Traveller characteristics"], [("2018-01", "Alberta", "P1", k, 1.0) for k in d.TOURISM]),
        "labour": _long(spark, ["Labour force characteristics", "Sex", "Age group", "Statistics", "Data type"],
                        [("2018-01", "Alberta", "P1", k, *both, 2.0) for k in d.LABOUR_COUNTS]),
        "crime": _long(spark, ["Violations", "Statistics"],
                       [("2018", "Alberta [48]", "P1", "Total, all violations", m, 36.0) for m in d.CRIME_MEASURE.values()]),
        "cpi": _long(spark, ["Alternative measures"],
                     [("2018-01", g, "X", m, v) for m in d.CPI_MEASURE.values() for g, v in (("Canada", 1.0), ("Elsewhere", 3.0))]),
        "fuel": _long(spark, ["Type of fuel"], [("2018-01", "Alberta", "P1", k, 5.0) for k in d.FUEL]),
        "migration": _long(spark, ["Interprovincial migration"], [("2018-01", "Alberta", "P1", k, v) for k, v in zip(d.MIGRATION, (5.0, 2.0))]),
        "immigrants": _long(spark, ["Components of population growth"], [("2018-01", "Alberta", "P1", "Immigrants", 4.0)]),
        "rates": spark.createDataFrame([("2018-01-03", *[1.0] * 12)], ["date", *RATE_VALUES]),
        "weather": spark.createDataFrame([("Alberta", "2018-01", *[0.5] * 5)] * 2, ["GEO", "REF_DATE", *d.WEATHER]),
    }
    parts = load_all(tables, by)
    panel = regional_panel(parts, by)
    assert panel.columns == panel_columns(by) and len(panel_columns("region")) == 78
    assert panel.count() == parts["housing"].count()
    key, name = ("DGUID", "P1") if by == "region" else ("province", "Alberta")
    row = panel.where(F.col(key) == name).first().asDict()
    p = "" if by == "region" else "avg_"
    expected = {"income": 2.0, "rent": 10.0, "domestic_tourism": 1.0, "employment": 2.0, "crime_incidents": 3.0, "cpi_index": 2.0,
                "diesel_fillingstations": 5.0, "immigrants": 7.0, "prime": 1.0}
    assert {k: row[p + k] for k in expected} == expected
    assert row["Total_Snow"] == 0.5 and row["uom_tourist"] == "Persons" and row["uom_cpi"]
    if by == "region":
        assert panel.columns == PANEL_COLUMNS
        other = panel.where("DGUID = 'C1'").first()
        assert other["uom_tourist"] is None and other["cpi_index"] == 2.0 and other["immigrants"] is None
