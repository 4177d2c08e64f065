"""Batch jobs: ``spark-submit run.py <job> ...``.

    panel     --statistics DIR --codes FILE --weather DIR --rates FILE --out DIR [--by province] [--form csv [--files N]] [--plain]
    combine   PARTS OUT          join headed listing part files into one table
    clean     IN OUT             clean raw listings (CSV without header)
    report    KIND IN            beds, baths, localities, provinces, highest, lowest or correlation of cleaned listings
    pages     IN OUT             listing rows out of stored pages (Parquet with url and html)
    workbook  KIND PANEL         unit, year or map: distinct index values [--measures NAME ...] [--approximate]
    forecast  KIND PANEL OUT     ridge, look-back or trees: predictions, and the model in OUT/model; ridge also leaves
                                 OUT/pipeline, which holds the preparation and scores rows of a panel as they are
    score     MODEL PANEL OUT    predictions of a pipeline for a panel's rows, with or without target

The last three read a panel by region, written as Parquet or, with ``--form csv``, as CSV.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.numbers import round_half_up
from panelwright.operators.regression import predict
from panelwright.operators.stages import load_pipeline
from panelwright.plans import forecast, listings, pages, workbook
from panelwright.plans.datasets import REGION_KEYS
from panelwright.plans.regional_panel import load_all, regional_panel
from panelwright.session import landed, ship
from panelwright.sources import files, sinks
from panelwright.sources.schemas import PRODUCTS
from panelwright.sources.statistics import statistics_table

REPORTS = {
    "beds": lambda rows: listings.price_range(rows, "Bed"),
    "baths": lambda rows: listings.price_range(rows, "Baths"),
    "localities": listings.most_expensive_localities,
    "provinces": listings.province_summary,
    "highest": lambda rows: listings.extreme_listings(rows, "max"),
    "lowest": lambda rows: listings.extreme_listings(rows, "min"),
    "correlation": listings.age_price_correlation,
}
SHEETS = {"unit": workbook.distinct_by_unit, "year": workbook.distinct_by_year, "map": workbook.distinct_on_map}


def scan_tables(spark: SparkSession, statistics: str, codes: str, weather: str, rates: str, zipped: bool = True) -> dict[str, DataFrame]:
    """All inputs of the panel.  Each statistics table lies in a folder named after its product id.

    Every archive is read once and lands as Parquet in the shared folder.
    """
    tables = {
        name: landed(statistics_table(spark, f"{statistics}/{product}", name, zipped), name)
        for name, (product, _) in PRODUCTS.items()
    }
    tables["uom"] = files.code_set(spark, codes, "uom")
    tables["scalar"] = files.code_set(spark, codes, "scalar")
    tables["weather"] = files.weather_files(spark, weather)
    tables["rates"] = files.daily_rates(spark, rates)
    return tables


def panel(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    tables = scan_tables(spark, a.statistics, a.codes, a.weather, a.rates, not a.plain)
    out = regional_panel(load_all(tables, a.by), a.by)
    if a.form == "csv":
        sinks.write_panel_csv(out, a.out, a.files)
    else:
        sinks.write_panel(out, a.out)
    return files.read_panel(spark, a.out, a.form, a.by)


def panel_by_region(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """A written panel that has the columns these jobs are about."""
    rows = files.read_panel(spark, a.panel, a.form)
    if forecast.TARGET not in rows.columns:
        raise ValueError(f"{a.panel} has no {forecast.TARGET}: the {a.job} job needs a panel by region")
    return rows


def fit(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    rows = panel_by_region(spark, a)
    if a.kind == "ridge":
        numbers = files.numeric_columns(rows.drop("house_only", "land_only", "total_house_land", "panel_year"))
        result = forecast.ridge_forecast(rows, numbers)
        modelled = rows.where(F.col("DGUID").isin(forecast.MODELLED_REGIONS))
        whole = forecast.fitted_pipeline(modelled.where(F.col("REF_DATE") < forecast.CUT), numbers)
        sinks.save_model(whole, f"{a.out}/pipeline")
    elif a.kind == "trees":
        result = forecast.look_back_trees(rows)
    else:
        result = forecast.look_back_forecast(rows)
    name = "predicted_total_house_index"
    sinks.write_predictions(forecast.with_predictions(rows, result.predictions, name, REGION_KEYS[::2]), f"{a.out}/predictions")
    sinks.save_model(result.model, f"{a.out}/model")
    errors = result.errors.select(
        "is_train", "n", *[round_half_up(c, 4).alias(c) for c in ("mae", "mse", "r2")]
    ).orderBy(F.desc("is_train"))
    errors.show()
    return errors


def score(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    scored = predict(load_pipeline(spark, a.model), files.read_panel(spark, a.panel, a.form))
    found = scored.select("DGUID", "REF_DATE", F.col("prediction").alias("predicted_total_house_index"))
    sinks.write_predictions(found, a.out)
    return found


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)
    p = jobs.add_parser("panel")
    for name in ("statistics", "codes", "weather", "rates", "out"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--by", choices=["region", "province"], default="region")
    p.add_argument("--form", choices=["parquet", "csv"], default="parquet")
    p.add_argument("--files", type=int, help="number of CSV files; as many as there are tasks if not given")
    p.add_argument("--plain", action="store_true", help="statistics are plain CSV files, not zip archives")
    for job in ("combine", "clean", "pages"):
        p = jobs.add_parser(job)
        p.add_argument("source")
        p.add_argument("out")
    p = jobs.add_parser("report")
    p.add_argument("kind", choices=list(REPORTS))
    p.add_argument("source")
    p = jobs.add_parser("workbook")
    p.add_argument("kind", choices=list(SHEETS))
    p.add_argument("panel")
    p.add_argument("--measures", nargs="+", default=["total_house_land"], choices=["total_house_land", "house_only", "land_only"])
    p.add_argument("--approximate", action="store_true", help="count by sketches, within a few per cent")
    p.add_argument("--form", choices=["parquet", "csv"], default="parquet")
    p = jobs.add_parser("forecast")
    p.add_argument("kind", choices=["ridge", "look-back", "trees"])
    p.add_argument("panel")
    p.add_argument("out")
    p.add_argument("--form", choices=["parquet", "csv"], default="parquet")
    p = jobs.add_parser("score")
    for name in ("model", "panel", "out"):
        p.add_argument(name)
    p.add_argument("--form", choices=["parquet", "csv"], default="parquet")
    return parser


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> DataFrame | None:
    a = _parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName(f"panelwright {a.job}").getOrCreate()
    ship(spark)
    if a.job == "panel":
        return panel(spark, a)
    if a.job == "forecast":
        return fit(spark, a)
    if a.job == "score":
        return score(spark, a)
    if a.job == "report":
        out = REPORTS[a.kind](files.clean_listings_file(spark, a.source))
    elif a.job == "workbook":
        out = SHEETS[a.kind](panel_by_region(spark, a), measures=a.measures, approximate=a.approximate)
    else:
        if a.job == "combine":
            rows = listings.combine_listings(spark, a.source)
        elif a.job == "clean":
            rows = listings.clean_listings(files.raw_listings(spark, a.source, header=False))
        else:
            rows = pages.listing_fields(spark.read.parquet(a.source).select("html"))
        sinks.write_listings(rows, a.out)
        return None
    out.show(truncate=False)
    return out
