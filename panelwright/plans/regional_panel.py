"""The 12-source regional panel in its two variants."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from panelwright.functions.numbers import net_flow
from panelwright.operators.lookups import region_ids
from panelwright.operators.panel import Feature, build_panel
from panelwright.operators.reshape import quoted
from panelwright.plans import datasets as d
from panelwright.session import landed
from panelwright.sources.schemas import PANEL_COLUMNS, RATE_VALUES


def load_all(tables: Mapping[str, DataFrame], by: str = "region") -> dict[str, DataFrame]:
    """All feature tables from the scanned ones.

    ``tables`` holds ``housing income expenditure tourism labour crime cpi fuel
    migration immigrants`` (long), ``rates`` (daily), ``weather`` (stations)
    and the code sets ``uom`` and ``scalar``.  What several of the results are
    made of is made once: the ids of the regions, and the rows of the spine,
    which the panel joins eleven times.
    """
    t = tables
    ids = landed(region_ids(t["housing"]), "ids") if by == "region" else None
    return {
        "housing": landed(d.housing(t["housing"], t["uom"], t["scalar"], by), "housing"),
        "income": d.income(t["income"], t["uom"], t["scalar"], by),
        "expenditure": d.expenditure(t["expenditure"], by),
        "tourism": d.tourism(t["tourism"], by),
        "labour": d.labour(t["labour"], by),
        "crime": d.crime(t["crime"], by),
        "cpi": d.cpi(t["cpi"], by),
        "fuel": d.fuel(t["fuel"], ids, by),
        "migration": d.migration(t["migration"], by),
        "immigrants": d.immigrants(t["immigrants"], by),
        "rates": d.rates(t["rates"], by),
        "weather": d.weather(t["weather"], ids, by),
    }


def panel_columns(by: str = "region") -> list[str]:
    """Columns of the panel in order; the province variant has no ids and no total index."""
    if by == "region":
        return list(PANEL_COLUMNS)
    texts = {"REF_DATE", *[c for c in PANEL_COLUMNS if c.startswith(("uom_", "scalar_", "statistic_"))]}
    kept = [c for c in PANEL_COLUMNS if c not in ("GEO", "DGUID", "total_house_land")]
    return ["province", *[c if c in texts or c in d.WEATHER else d.avg_name(c) for c in kept]]


def regional_panel(parts: Mapping[str, DataFrame], by: str = "region", duplicates: str = "raise") -> DataFrame:
    """One row per row of the housing table, with the columns of the other eleven sources.

    Annual amounts are given per month; net migration is in + immigrants - out.
    ``duplicates`` is the rule for regional sources with several rows of one key.
    """
    region = "DGUID" if by == "region" else "province"
    name = (lambda c: c) if by == "region" else d.avg_name

    def values(columns) -> list[str]:
        return [name(c) for c in columns]

    spending = values(d.EXPENDITURE.values())
    moves = values(d.MIGRATION.values())
    arrivals = parts["immigrants"].withColumnRenamed(name("immigrants"), "_arrivals")
    features = [
        Feature(parts["income"], ["uom_income", "scalar_income", "statistic_income", *values(["income"])],
                grain="year", annual=values(["income"]), duplicates=duplicates),
        Feature(parts["expenditure"], spending, grain="year", annual=spending, duplicates=duplicates,
                tags=d.EXPENDITURE_TAGS),
        Feature(parts["tourism"], values(d.TOURISM.values()), duplicates=duplicates, tags=d.TOURISM_TAGS),
        Feature(parts["labour"], values([*d.LABOUR_COUNTS.values(), *d.LABOUR_RATES.values()]),
                duplicates=duplicates, tags=d.LABOUR_TAGS),
        Feature(parts["crime"], values(["crime_incidents"]), grain="year", annual=values(["crime_incidents"]),
                duplicates=duplicates, tags=d.crime_tags(by)),
        Feature(parts["cpi"], values(["cpi_index"]), by="national", duplicates="mean", tags=d.cpi_tags(by)),
        Feature(parts["fuel"], values(d.FUEL.values()), duplicates=duplicates, tags=d.fuel_tags(by)),
        Feature(parts["migration"], moves, duplicates=duplicates, tags=d.MIGRATION_TAGS),
        Feature(arrivals, ["_arrivals"], duplicates=duplicates),
        Feature(parts["rates"], values(RATE_VALUES), by="national", duplicates="unique"),
        Feature(parts["weather"], d.WEATHER, duplicates=duplicates),
    ]
    joined = build_panel(parts["housing"], features, region=region)
    flow = net_flow(moves[0], "_arrivals", moves[1])
    return joined.withColumn(name("immigrants"), flow).select(*[quoted(c) for c in panel_columns(by)])
