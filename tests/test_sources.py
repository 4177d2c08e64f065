from __future__ import annotations

import json
import zipfile

import pytest
from pyspark.errors import AnalysisException

from panelwright.plans import datasets, listings
from panelwright.sources import files, schemas, sinks, statistics


def test_zip_reads_the_first_member_only(spark, tmp_path):
    columns = schemas.statistics_columns("cpi")
    header = ",".join(f'"{c}"' for c in columns[::-1])  # columns are found by name, not by position
    row = ",".join({"VALUE": "1.5", "REF_DATE": "2018-01", "GEO": '"Canada, all"', "UOM_ID": "17"}.get(c, "") for c in columns[::-1])
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("table.csv", f"﻿{header}\n{row}\n" * 1)
        archive.writestr("meta.csv", "x,y\n1,2\n")
    (tmp_path / "notes.txt").write_text("no archive")
    rows = statistics.statistics_table(spark, str(tmp_path), "cpi").collect()
    assert len(rows) == 1
    assert (rows[0]["REF_DATE"], rows[0]["GEO"], rows[0]["VALUE"], rows[0]["UOM_ID"]) == ("2018-01", "Canada, all", 1.5, 17)
    assert rows[0]["DGUID"] is None and rows[0]["SYMBOL"] is None


def test_zip_in_batches(spark, tmp_path, monkeypatch):
    lines = "".join(f"2018-01,P{i},{i}\n" for i in range(1000))
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("t.csv", "REF_DATE,GEO,VALUE\n" + lines)
    monkeypatch.setattr(statistics, "_ROWS_PER_BATCH", 64)
    df = statistics.typed(statistics.read_zipped(spark, str(tmp_path), ["REF_DATE", "GEO", "VALUE"]))
    assert df.count() == 1000 and df.agg({"VALUE": "sum"}).first()[0] == 499500.0
    statistics.land(df, str(tmp_path / "landed"))
    assert spark.read.parquet(str(tmp_path / "landed")).count() == 1000


def test_csv_with_bad_value(spark, tmp_path):
    (tmp_path / "t.csv").write_text('REF_DATE,GEO,VALUE\n2018-01,"A, B",1.5\n2018-02,C,x\n2018-03,D,\n')
    rows = statistics.typed(statistics.read_csv(spark, str(tmp_path), ["REF_DATE", "GEO", "VALUE"])).collect()
    assert [r["VALUE"] for r in rows] == [1.5, None, None]


def test_code_sets(spark, tmp_path):
    catalogue = {"object": {
        "uom": [{"memberUomCode": 17, "memberUomEn": "Index, 201612=100", "memberUomFr": None}],
        "scalar": [{"scalarFactorCode": 0, "scalarFactorDescEn": "units", "scalarFactorDescFr": "unités"}],
        "frequency": [{"frequencyCode": 1, "frequencyDescEn": "Daily"}],
        "symbol": [{"symbolCode": "0", "symbolRepresentationEn": "a", "symbolRepresentationFr": "b"}],
        "classificationType": [{"classificationTypeCode": 2, "classificationTypeEn": "x"}],
    }}
    path = tmp_path / "codes.json"
    path.write_text(json.dumps(catalogue, indent=1))
    for kind in schemas.CODE_SETS:
        assert files.code_set(spark, str(path), kind).count() == 1
    uom = files.code_set(spark, str(path), "uom").first()
    assert uom["memberUomEn"] == "Index, 201612=100" and uom["memberUomFr"] is None


def _weather_line(month, value, quoted=False):
    cells = [month, month[:4], month[5:], value, "E", *[""] * 20]
    return ",".join(f'"{c}"' for c in cells) if quoted else ",".join(cells)


def test_weather_directory(spark, tmp_path):
    header = ",".join(["Date/Time", "Year", "Month", *["x"] * 22])
    (tmp_path / "New Brunswick_weather.csv").write_text(
        "﻿" + header + "\n" + _weather_line("1985-01", "-3.5") + "\n" + _weather_line("1985-01", "-3.5") + "\n"
    )
    preamble = '﻿"Station Name","X"\n"Province","YUKON"\n\n"Legend"\n"M","Missing"\n\n'
    (tmp_path / "Yukon_weather.csv").write_text(
        preamble + header + "\n" + _weather_line("1998-02", "-6.8", True) + "\n" + _weather_line("1998-03", "", True) + "\n"
    )
    rows = files.weather_files(spark, str(tmp_path))
    found = sorted((r["GEO"], r["REF_DATE"], r["Mean_Max_Temp"]) for r in rows.collect())
    assert found == [
        ("New Brunswick", "1985-01", -3.5), ("New Brunswick", "1985-01", -3.5),
        ("Yukon", "1998-02", -6.8), ("Yukon", "1998-03", None),
    ]
    housing = spark.createDataFrame(
        [("1998-02", "Yukon", "Y1", 1.0), ("1998-02", "New Brunswick", "N1", 1.0), ("1998-02", "Nunavut", "U1", None)],
        "REF_DATE string, GEO string, DGUID string, VALUE double",
    )
    joined = datasets.weather(rows, housing)
    assert sorted((r["DGUID"], r["REF_DATE"]) for r in joined.collect()) == [
        ("N1", "1985-01"), ("Y1", "1998-02"), ("Y1", "1998-03")
    ]
    assert datasets.weather(rows, by="province").count() == 3  # a repeated row counts once


def test_weather_lines_and_what_is_wrong_with_them(spark, tmp_path):
    good, bad = _weather_line("1985-01", "-3.5"), _weather_line("1985-02", "warm", True)
    short = "1985-03,1985,03,1.0,E"
    (tmp_path / "New Brunswick_weather.csv").write_text(f'\ufeff"Station","X"\n\n{good}\n{good}\n{bad}\n{short}\n1985-13,{"," * 23}\n')
    (tmp_path / "Yukon_weather.csv").write_text("")
    rows, wrong = files.weather_lines(spark, str(tmp_path))
    scanned = files.weather_files(spark, str(tmp_path))
    assert rows.columns == scanned.columns
    assert sorted(map(str, rows.collect())) == sorted(map(str, scanned.collect())) and rows.count() == 4
    found = sorted((r["file"], r["line"].lstrip("\ufeff"), r["reason"], r["kept"]) for r in wrong.collect())
    name = "New Brunswick_weather.csv"
    assert found == sorted([
        (name, '"Station","X"', "no month", False), (name, bad, "no number", True), (name, short, "fields", True),
        (name, f"1985-13,{',' * 23}", "no month", False),
    ])
    assert {r["GEO"] for r in wrong.collect()} == {"New Brunswick"}


def test_daily_rates(spark, tmp_path):
    lines = ["date," + ",".join(schemas.RATE_VALUES)]
    lines += ["2018-01-03," + ",".join(["1.0"] * 12), "2018-01-10," + ",".join(["3.0"] * 11 + [""]), "2018-02-01," + ",".join(["5"] * 12)]
    (tmp_path / "rates.csv").write_text("\n".join(lines) + "\n")
    monthly = {r["REF_DATE"]: r for r in datasets.rates(files.daily_rates(spark, str(tmp_path / "rates.csv"))).collect()}
    assert set(monthly) == {"2018-01", "2018-02"}
    assert monthly["2018-01"]["1y_fixed_posted"] == 2.0 and monthly["2018-01"]["prime"] == 1.0


def test_combine_and_write_listings(spark, tmp_path):
    parts = tmp_path / "parts"
    parts.mkdir()
    header = "province,listprice,date added,locality,postal code,year built,taxes,Basement,Lot Size,Bed,Baths,Area\n"
    (parts / "part1.csv").write_text(header + 'BC,"$ 1,200,000",5-Nov-18,Surrey,V1,1990,,,,3,2,"1,200"\n')
    (parts / "part2.csv").write_text(header + 'AB,"$ 500,000",1-Jan-18,Calgary,T1,,,,,10,1,800\n')
    raw = listings.combine_listings(spark, str(parts / "*.csv"))
    assert raw.count() == 2
    clean = listings.clean_listings(raw)
    out = str(tmp_path / "clean")
    sinks.write_listings(clean, out)
    back = files.clean_listings_file(spark, out)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, clean.collect()))
    with pytest.raises(AnalysisException):
        sinks.write_listings(clean, out)


def test_panel_csv_round_trip(spark, tmp_path):
    panel = spark.createDataFrame(
        [tuple("2018-01" if n == "REF_DATE" else "x" if n in schemas.PANEL_TEXT else 1.5 for n in schemas.PANEL_COLUMNS)],
        schemas.PANEL,
    )
    assert len(panel.columns) == 78
    sinks.write_panel_csv(panel, str(tmp_path / "csv"), files=1)
    assert files.read_panel(spark, str(tmp_path / "csv"), "csv").collect() == panel.collect()
    sinks.write_panel(panel, str(tmp_path / "parquet"))
    assert (tmp_path / "parquet" / "panel_year=2018").is_dir()
    assert files.keys_and_numbers(panel, ["GEO"]).columns == ["GEO", *[c for c in panel.columns if c not in schemas.PANEL_TEXT]]
