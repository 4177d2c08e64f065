"""The batch jobs over files as a user would land them."""

from __future__ import annotations

import json
import zipfile

import pytest

from panelwright.jobs import main
from panelwright.plans import datasets as d
from panelwright.sources.files import clean_listings_file
from panelwright.sources.schemas import PRODUCTS, RATE_VALUES, statistics_columns

REGIONS = {"Ontario": "2016A000235", "Quebec": "2016A000224", "Alberta": "2016A000248"}
MONTHS = [f"{y}-{m:02d}" for y in (2015, 2016, 2017, 2018) for m in range(1, 13)]


def _csv(table, rows):
    columns = statistics_columns(table)
    lines = [",".join(f'"{c}"' for c in columns)]
    for row in rows:
        values = {"UOM_ID": "17", "SCALAR_ID": "0", **row}
        lines.append(",".join('"' + str(values.get(c, "")) + '"' for c in columns))
    return "\n".join(lines) + "\n"


def _rows(table):
    annual = table in ("income", "expenditure", "crime")
    fixed = {
        "housing": [{"New housing price indexes": k} for k in d.HOUSING],
        "income": [{"Sex": "Both sexes", "Age group": "All age groups", "Persons with income": k} for k in d.INCOME_MEASURE.values()],
        "expenditure": [{"Household expenditures, summary-level categories": k} for k in [*d.EXPENDITURE, "Education"]],
        "tourism": [{"Traveller characteristics": k} for k in d.TOURISM],
        "labour": [{"Labour force characteristics": k, "Sex": "Both sexes", "Statistics": "Estimate", "Data type": "Seasonally adjusted"}
                   for k in [*d.LABOUR_COUNTS, *d.LABOUR_RATES]],
        "crime": [{"Violations": "Total, all violations", "Statistics": k} for k in d.CRIME_MEASURE.values()],
        "cpi": [{"Alternative measures": k} for k in d.CPI_MEASURE.values()],
        "fuel": [{"Type of fuel": k} for k in d.FUEL],
        "migration": [{"Interprovincial migration": k} for k in d.MIGRATION],
        "immigrants": [{"Components of population growth": "Immigrants"}],
    }[table]
    out = []
    for r, (geo, dguid) in enumerate(REGIONS.items()):
        for t, period in enumerate(sorted({m[:4] for m in MONTHS}) if annual else MONTHS):
            for k, extra in enumerate(fixed):
                place = "Canada" if table == "cpi" else f"Toronto, {geo}" if table == "fuel" else geo
                if table == "cpi" and r:
                    continue
                out.append({"REF_DATE": period, "GEO": place, "DGUID": f"{dguid}x" if table == "fuel" else dguid,
                            "VALUE": round(50 + 10 * r + t * 0.7 + k + (t * 7 % 5) * 0.1, 3), **extra})
    return out


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    for table, (product, _) in PRODUCTS.items():
        folder = root / "statistics" / product
        folder.mkdir(parents=True)
        with zipfile.ZipFile(folder / f"{product}-eng.zip", "w") as archive:
            archive.writestr(f"{product}.csv", _csv(table, _rows(table)))
            archive.writestr(f"{product}_MetaData.csv", "a,b\n1,2\n")
    (root / "codes.json").write_text(json.dumps({"object": {
        "uom": [{"memberUomCode": 17, "memberUomEn": "Index, 201612=100", "memberUomFr": "x"}],
        "scalar": [{"scalarFactorCode": 0, "scalarFactorDescEn": "units ", "scalarFactorDescFr": "x"}],
    }}))
    (root / "weather").mkdir()
    for geo in REGIONS:
        lines = ["Date/Time,Year,Month" + ",x" * 22] + [f"{m},{m[:4]},{m[5:]}" + ",1.5,E" * 11 for m in MONTHS]
        (root / "weather" / f"{geo}_weather.csv").write_text("\n".join(lines) + "\n")
    lines = ["date," + ",".join(RATE_VALUES)] + [f"{m}-{day:02d}" + ",2.5" * 12 for m in MONTHS for day in (1, 15)]
    (root / "rates.csv").write_text("\n".join(lines) + "\n")
    return root


@pytest.fixture(scope="module")
def panel_path(spark, landing):
    out = str(landing / "panel")
    main(["panel", "--statistics", f"{landing}/statistics", "--codes", f"{landing}/codes.json", "--weather",
          f"{landing}/weather", "--rates", f"{landing}/rates.csv", "--out", out], spark)
    return out


def test_panel_job(spark, landing, panel_path):
    panel = spark.read.parquet(panel_path)
    assert panel.count() == len(REGIONS) * len(MONTHS) and len(panel.drop("panel_year").columns) == 78
    row = panel.where("GEO = 'Ontario' AND REF_DATE = '2016-03'").first()
    assert all(row[c] is not None for c in panel.columns), [c for c in panel.columns if row[c] is None]
    assert row["income"] == round(50.7 / 12 + 0.2 / 12, 2) and row["Total_Snow"] == 1.5 and row["prime"] == 2.5
    by_province = main(["panel", "--statistics", f"{landing}/statistics", "--codes", f"{landing}/codes.json", "--weather",
                        f"{landing}/weather", "--rates", f"{landing}/rates.csv", "--out", f"{landing}/p", "--by", "province", "--form", "csv"], spark)
    assert by_province.count() == len(REGIONS) * len(MONTHS) and by_province.columns[0] == "province"


def test_csv_panel_feeds_workbook_and_forecast(spark, landing):
    arguments = ["panel", "--statistics", f"{landing}/statistics", "--codes", f"{landing}/codes.json", "--weather",
                 f"{landing}/weather", "--rates", f"{landing}/rates.csv", "--form", "csv"]
    panel = main([*arguments, "--out", f"{landing}/as_csv", "--files", "1"], spark)
    assert len(list((landing / "as_csv").glob("*.csv"))) == 1
    assert dict(panel.dtypes)["income"] == "double" and panel.count() == len(REGIONS) * len(MONTHS)
    assert main(["workbook", "unit", f"{landing}/as_csv", "--form", "csv"], spark).count() == 12
    errors = main(["forecast", "ridge", f"{landing}/as_csv", f"{landing}/from_csv", "--form", "csv"], spark)
    assert errors.where("is_train").first()["r2"] > 0.9
    main([*arguments, "--out", f"{landing}/by_province", "--by", "province"], spark)
    with pytest.raises(ValueError, match="no panel by region"):
        main(["workbook", "unit", f"{landing}/by_province", "--form", "csv"], spark)
    with pytest.raises(ValueError, match="no panel by region"):
        main(["forecast", "ridge", f"{landing}/by_province", f"{landing}/x", "--form", "csv"], spark)


def test_workbook_and_forecast_jobs(spark, landing, panel_path):
    assert main(["workbook", "map", panel_path], spark).count() == 12
    assert main(["workbook", "unit", panel_path], spark).count() == 12
    assert main(["workbook", "year", panel_path], spark).count() == 12
    both = main(["workbook", "year", panel_path, "--approximate", "--measures", "house_only", "land_only"], spark)
    assert both.columns[-2:] == ["distinct_house_only", "distinct_land_only"] and both.count() == 12
    for kind in ("ridge", "look-back", "trees"):
        errors = {r["is_train"]: r for r in main(["forecast", kind, panel_path, f"{landing}/{kind}"], spark).collect()}
        assert errors[True]["r2"] > (0.5 if kind == "trees" else 0.9) and errors[False]["n"] == 36
        rows = spark.read.option("header", True).csv(f"{landing}/{kind}/predictions")
        assert rows.count() == (144 if kind == "ridge" else 144 - 3 * 6) and "predicted_total_house_index" in rows.columns
    scored = main(["score", f"{landing}/ridge/pipeline", panel_path, f"{landing}/scored"], spark)
    assert scored.count() == spark.read.parquet(panel_path).count() and scored.where("predicted_total_house_index IS NULL").count() == 0
    assert spark.read.option("header", True).csv(f"{landing}/scored").count() == scored.count()


def test_listing_jobs(spark, tmp_path):
    (tmp_path / "parts").mkdir()
    odd = 'ON,"$ 700,000",2-Feb-18,"Deux ""Rives"", Est\nNord",K1,1980,,,"50"" x 120"", deep",2,1,900\n'
    header = "province,listprice,date added,locality,postal code,year built,taxes,Basement,Lot Size,Bed,Baths,Area\n"
    for i, line in enumerate(['BC,"$ 1,200,000",5-Nov-18,Surrey,V1,1990,,,,3,2,"1,200"\n', 'AB,"$ 500,000",1-Jan-18,Calgary,T1,,,,,10,1,800\n' + odd]):
        (tmp_path / "parts" / f"part{i}.csv").write_text(header + line)
    main(["combine", f"{tmp_path}/parts", f"{tmp_path}/all"], spark)
    main(["clean", f"{tmp_path}/all", f"{tmp_path}/clean"], spark)
    row = clean_listings_file(spark, f"{tmp_path}/clean").where("province = 'ON'").first()
    assert (row["locality"], row["Lot_size"], row["Bed"], row["Area"]) == ('Deux "Rives", Est\nNord', '50" x 120", deep', "2", 900.0)
    expected = {"beds": 3, "baths": 2, "localities": 3, "provinces": 3, "highest": 3, "lowest": 3, "correlation": 1}
    for kind, rows in expected.items():
        assert main(["report", kind, f"{tmp_path}/clean"], spark).count() == rows
