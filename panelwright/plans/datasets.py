"""The enrichment sources of the regional panel.

Each function takes scanned tables (columns as in ``sources.schemas``, VALUE
typed) and returns one feature table.  ``by="region"`` keys it by (GEO, DGUID,
REF_DATE); ``by="province"`` rolls place labels up to province names and
averages, with an ``avg_`` prefix on the value columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.dates import month_of
from panelwright.functions.labels import after_last_comma, province_of, rewrite_border_cities, strip_code
from panelwright.operators.lookups import code_lookup, detail_and_average, name_to_id
from panelwright.operators.reshape import keep_all_equal, pivot_mean, quoted, with_tags
from panelwright.sources.schemas import RATE_VALUES
from panelwright.session import landed

REGION_KEYS = ["REF_DATE", "GEO", "DGUID"]
LABEL_KEYS = ["REF_DATE", "GEO"]

# Categories of the statistics tables and the feature each becomes.
HOUSING = {
    "House only": "house_only",
    "Land only": "land_only",
    "Total (house and land)": "total_house_land",
}
EXPENDITURE = {
    "Food expenditures": "food_expenditures",
    "Income taxes": "income_taxes",
    "Mortgage insurance premiums for owned living quarters": "mortageinsurance",
    "Mortgage paid for owned living quarters": "mortagePaid",
    "Principal accommodation": "accomodation",
    "Rent": "rent",
    "Shelter": "shelter",
    "Total expenditure": "total_expenditure",
    "Transfer taxes and land registration fees for owned living quarters": "taxes_landregfees",
}
EDUCATION = {"Education": "education"}
TOURISM = {
    "Total international travellers": "international_tourism",
    "Total Canadian residents": "domestic_tourism",
}
LABOUR_COUNTS = {
    "Employment": "employment",
    "Full-time employment": "fulltime",
    "Labour force": "labourforce",
    "Part-time employment": "parttime",
    "Population": "population",
    "Unemployment": "unemployment",
}
LABOUR_RATES = {
    "Employment rate": "employment_rate",
    "Participation rate": "participationrate",
    "Unemployment rate": "unemployment_rate",
}
FUEL = {
    "Diesel fuel at full service filling stations": "diesel_fillingstations",
    "Diesel fuel at self service filling stations": "diesel_selfservstations",
    "Premium unleaded gasoline at full service filling stations": "premium_fillingstations",
    "Premium unleaded gasoline at self service filling stations": "premium_selfservstations",
    "Regular unleaded gasoline at full service filling stations": "regular_fillingstations",
    "Regular unleaded gasoline at self service filling stations": "regular_selfservstations",
}
MIGRATION = {"In-migrants": "in_migrants", "Out-migrants": "out_migrants"}
IMMIGRANTS = {"Immigrants": "immigrants"}
WEATHER = ["Mean_Max_Temp", "Mean_Min_Temp", "Mean_Temp", "Total_Rain", "Total_Snow"]

# The statistic that is picked from a table, by variant.
INCOME_MEASURE = {"region": "5-year percent change of median income", "province": "Median total income"}
CRIME_MEASURE = {"region": "Rate per 100,000 population", "province": "Actual incidents"}
CPI_MEASURE = {
    "region": "Measure of core inflation based on a factor model, CPI-common (year-over-year percent change)",
    "province": (
        "Consumer Price Index (CPI), all-items excluding eight of the most volatile components as defined by "
        "the Bank of Canada and excluding the effect of changes in indirect taxes, seasonally adjusted"
    ),
}

# Unit, scalar and statistic texts of the sources; those of housing and income come from the code sets.
EXPENDITURE_TAGS = {
    "uom_expenditure": "Dollars",
    "scalar_expenditure": "unit",
    "statistic_expenditure": "Average expenditure per household",
}
TOURISM_TAGS = {"uom_tourist": "Persons", "scalar_tourist": "unit"}
LABOUR_TAGS = {
    "uom_labourforce": "Persons",
    "scalar_labourforce": "thousands",
    "statistic_labourforce": "Both sexes, All age groups, Seasonally adjusted",
    "uom_lfperc": "Percentage",
    "scalar_lfperc": "unit",
    "statistic_labourforceperc": "Both sexes, All age groups, Seasonally adjusted",
}
MIGRATION_TAGS = {"uom_imm": "Persons", "scalar_imm": "units"}
IMMIGRANTS_TAGS = {"uom_imm2": "Persons", "scalar_imm2": "units"}


def crime_tags(by: str) -> dict[str, str]:
    return {
        "uom_crime": "Number",
        "scalar_crime": "unit",
        "statistic_crime": f"Total of all violations-{CRIME_MEASURE[by]}",
    }


def cpi_tags(by: str) -> dict[str, str]:
    return {"uom_cpi": "Percent" if by == "region" else "2002=100", "scalar_cpi": "unit"}


def fuel_tags(by: str) -> dict[str, str]:
    return {"uom_oil": "Cents per litre", "scalar_oil": "units" if by == "region" else "units "}



def avg_name(name: str) -> str:
    """Name of a value column in the province variant."""
    return "avg_unemploymentrate" if name == "unemployment_rate" else f"avg_{name}"


def _check(by: str) -> None:
    if by not in ("region", "province"):
        raise ValueError(f"by must be region or province, not {by}")


def _keys(by: str) -> list[str]:
    _check(by)
    return REGION_KEYS if by == "region" else LABEL_KEYS


def province_mean(df: DataFrame, label: Column, columns: Sequence[str], tags: Sequence[str] = ()) -> DataFrame:
    """Unweighted mean of label rows per (province, REF_DATE, tags).

    A label that is itself a province counts as one row like its cities.
    """
    keys = [label.alias("province"), F.col("REF_DATE"), *[F.col(t) for t in tags]]
    return df.groupBy(*keys).agg(*[F.avg(quoted(c)).alias(avg_name(c)) for c in columns])


def housing(long: DataFrame, uom: DataFrame, scalar: DataFrame, by: str = "region", own_rows: bool = True) -> DataFrame:
    """House price indexes with the unit and scalar texts of their codes.

    ``own_rows=False`` leaves rows labelled with the province itself out of its average.
    """
    _check(by)
    wide = pivot_mean(long, [*_keys(by), "UOM_ID", "SCALAR_ID"], "New housing price indexes", HOUSING)
    wide = code_lookup(wide, "UOM_ID", uom, "memberUomCode", "memberUomEn", "_uom")
    wide = code_lookup(wide, "SCALAR_ID", scalar, "scalarFactorCode", "scalarFactorDescEn", "_scalar")
    units = [F.trim("_uom").alias("uom_houseindex"), F.trim("_scalar").alias("scalar_houseindex")]
    month = F.trim("REF_DATE").alias("REF_DATE")
    if by == "region":
        keys = [F.trim("GEO").alias("GEO"), F.trim("DGUID").alias("DGUID"), month, *units]
        return wide.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in HOUSING.values()])
    label = after_last_comma(rewrite_border_cities("GEO"))
    if not own_rows:
        wide = wide.where(F.trim("GEO") != label)
    keys = [label.alias("province"), month, *units]
    return wide.groupBy(*keys).agg(*[F.avg(c).alias(avg_name(c)) for c in HOUSING.values()])


def income(long: DataFrame, uom: DataFrame, scalar: DataFrame, by: str = "region") -> DataFrame:
    """Income statistic of all persons, with the texts of its unit and scalar codes."""
    _check(by)
    kept = keep_all_equal(
        long, Sex="Both sexes", **{"Age group": "All age groups", "Persons with income": INCOME_MEASURE[by]}
    )
    named = code_lookup(kept, "UOM_ID", uom, "memberUomCode", "memberUomEn", "uom_income")
    named = code_lookup(named, "SCALAR_ID", scalar, "scalarFactorCode", "scalarFactorDescEn", "scalar_income")
    if by == "region":
        tagged = with_tags(named, statistic_income=f"{INCOME_MEASURE[by]}, Both sexes, All age groups")
        return tagged.select(
            "GEO", "DGUID", "REF_DATE", "uom_income", "scalar_income", "statistic_income",
            F.col("VALUE").alias("income"),
        )
    means = province_mean(
        named.withColumnRenamed("VALUE", "income"), after_last_comma("GEO"), ["income"], ["uom_income", "scalar_income"]
    )
    return with_tags(means, statistic_income=f"{INCOME_MEASURE[by]},Both sexes,All age groups")


def expenditure(long: DataFrame, by: str = "region") -> DataFrame:
    """Household expenditure per category, every category under its own name."""
    _check(by)
    names = {**EXPENDITURE, **EDUCATION} if by == "region" else EXPENDITURE
    wide = pivot_mean(long, _keys(by), "Household expenditures, summary-level categories", names)
    if by == "province":
        wide = province_mean(wide, F.col("GEO"), list(names.values()))
    return with_tags(wide, **EXPENDITURE_TAGS)


def tourism(long: DataFrame, by: str = "region") -> DataFrame:
    """International and domestic travellers, every kind under its own name."""
    wide = pivot_mean(long, _keys(by), "Traveller characteristics", TOURISM)
    if by == "province":
        wide = province_mean(wide, after_last_comma("GEO"), list(TOURISM.values()))
    return with_tags(wide, **TOURISM_TAGS)


def labour(long: DataFrame, by: str = "region", age_group: str | None = None) -> DataFrame:
    """Seasonally adjusted labour estimates; a mean over age groups unless one is named."""
    kept = keep_all_equal(long, Sex="Both sexes", Statistics="Estimate", **{"Data type": "Seasonally adjusted"})
    if age_group is not None:
        kept = keep_all_equal(kept, **{"Age group": age_group})
    names = {**LABOUR_COUNTS, **LABOUR_RATES}
    wide = pivot_mean(kept, _keys(by), "Labour force characteristics", names)
    if by == "province":
        wide = province_mean(wide, F.col("GEO"), list(names.values()))
    tags = LABOUR_TAGS
    if age_group is not None:
        tags = {k: v.replace("All age groups", age_group) for k, v in tags.items()}
    return with_tags(wide, **tags)


def crime(long: DataFrame, by: str = "region") -> DataFrame:
    """All violations: rate per 100,000 persons by region, actual incidents by province."""
    _check(by)
    kept = keep_all_equal(long, Violations="Total, all violations", Statistics=CRIME_MEASURE[by])
    if by == "region":
        out = kept.select("GEO", "REF_DATE", "DGUID", F.col("VALUE").alias("crime_incidents"))
    else:
        named = kept.withColumnRenamed("VALUE", "crime_incidents")
        out = province_mean(named, strip_code(after_last_comma("GEO")), ["crime_incidents"])
    return with_tags(out, **crime_tags(by))


def cpi(long: DataFrame, by: str = "region") -> DataFrame:
    """Consumer price measure per month and label."""
    _check(by)
    wide = pivot_mean(long, LABEL_KEYS, "Alternative measures", {CPI_MEASURE[by]: "cpi_index"})
    if by == "province":
        wide = province_mean(wide, F.col("GEO"), ["cpi_index"])
    return with_tags(wide, **cpi_tags(by))


def fuel(long: DataFrame, ids: DataFrame | None = None, by: str = "region", keep_duplicates: bool = False) -> DataFrame:
    """Fuel prices of cities and, under the province's own id, the mean of its cities.

    ``ids`` are the :func:`region_ids` of the housing table.  The region variant
    uses the pivoted rows three times, so they are written once.
    """
    prices = list(FUEL.values())
    wide = pivot_mean(long, _keys(by), "Type of fuel", FUEL)
    label = province_of("GEO")
    if by == "province":
        means = province_mean(wide, label, prices)
        return with_tags(means, **fuel_tags(by))
    if ids is None:
        raise ValueError("the ids of provinces come from the housing table")
    wide = landed(wide, "fuel")
    means = wide.groupBy(label.alias("GEO"), "REF_DATE").agg(*[F.avg(c).alias(c) for c in prices])
    averages = name_to_id(means, ids)
    both = detail_and_average(wide, averages, ["DGUID", "REF_DATE"], keep_duplicates)
    return with_tags(both, **fuel_tags(by))


def migration(long: DataFrame, by: str = "region") -> DataFrame:
    """People moving in from and out to other provinces."""
    wide = pivot_mean(long, _keys(by), "Interprovincial migration", MIGRATION)
    if by == "province":
        wide = province_mean(wide, F.col("GEO"), list(MIGRATION.values()))
    return with_tags(wide, **MIGRATION_TAGS)


def immigrants(long: DataFrame, by: str = "region") -> DataFrame:
    """People arriving from abroad."""
    wide = pivot_mean(long, _keys(by), "Components of population growth", IMMIGRANTS)
    if by == "province":
        wide = province_mean(wide, F.col("GEO"), list(IMMIGRANTS.values()))
    return with_tags(wide, **IMMIGRANTS_TAGS)


def rates(daily: DataFrame, by: str = "region") -> DataFrame:
    """Monthly means of the daily rate series."""
    _check(by)
    rename = (lambda c: c) if by == "region" else avg_name
    return daily.groupBy(month_of("date").alias("REF_DATE")).agg(
        *[F.avg(quoted(c)).alias(rename(c)) for c in RATE_VALUES]
    )


def weather(stations: DataFrame, ids: DataFrame | None = None, by: str = "region") -> DataFrame:
    """Monthly weather per region without repeated rows; the region variant adds the id of the label."""
    _check(by)
    rows = stations.select("GEO", "REF_DATE", *WEATHER).dropDuplicates()
    if by == "province":
        return rows.withColumnRenamed("GEO", "province")
    if ids is None:
        raise ValueError("the ids of regions come from the housing table")
    return name_to_id(rows, ids)
