"""Column layouts of the input tables.  All values are fixed by the publishers of the data."""

from __future__ import annotations

from pyspark.sql.types import DateType, DecimalType, DoubleType, IntegerType, StringType, StructField, StructType


def text_schema(*names: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


# Columns that every long statistics table ends with.
_TAIL = [
    "UOM", "UOM_ID", "SCALAR_FACTOR", "SCALAR_ID", "VECTOR", "COORDINATE", "VALUE",
    "STATUS", "SYMBOL", "TERMINATED", "DECIMALS",
]

# Product id of each long statistics table and the columns between the keys and the tail.
PRODUCTS = {
    "housing": ("18100205", ["New housing price indexes"]),
    "income": ("11100008", ["Sex", "Age group", "Persons with income"]),
    "expenditure": ("11100222", ["Statistic", "Household expenditures, summary-level categories"]),
    "tourism": ("24100041", ["Traveller characteristics", "Seasonal adjustment"]),
    "labour": ("14100287", ["Labour force characteristics", "Sex", "Age group", "Statistics", "Data type"]),
    "crime": ("35100177", ["Violations", "Statistics"]),
    "cpi": ("18100256", ["Alternative measures"]),
    "fuel": ("18100001", ["Type of fuel"]),
    "migration": ("17100020", ["Interprovincial migration"]),
    "immigrants": ("17100040", ["Components of population growth"]),
}


def statistics_columns(table: str) -> list[str]:
    """Header of a long statistics table."""
    return ["REF_DATE", "GEO", "DGUID", *PRODUCTS[table][1], *_TAIL]


# Fields of the code sets.
CODE_SETS = {
    "scalar": StructType([
        StructField("scalarFactorCode", IntegerType()),
        StructField("scalarFactorDescEn", StringType()),
        StructField("scalarFactorDescFr", StringType()),
    ]),
    "frequency": StructType([
        StructField("frequencyCode", IntegerType()),
        StructField("frequencyDescEn", StringType()),
        StructField("frequencyDescFr", StringType()),
    ]),
    "symbol": StructType([
        StructField("symbolCode", StringType()),
        StructField("symbolRepresentationEn", StringType()),
        StructField("symbolRepresentationFr", StringType()),
        StructField("symbolDescEn", StringType()),
        StructField("symbolDescFr", StringType()),
    ]),
    "uom": StructType([
        StructField("memberUomCode", IntegerType()),
        StructField("memberUomEn", StringType()),
        StructField("memberUomFr", StringType()),
    ]),
    "classificationType": StructType([
        StructField("classificationTypeCode", IntegerType()),
        StructField("classificationTypeEn", StringType()),
        StructField("classificationTypeFr", StringType()),
    ]),
}

# Columns of a station weather file, value and flag in turn.
WEATHER_VALUES = [
    "Mean_Max_Temp", "Mean_Min_Temp", "Mean_Temp", "Extr_Max_Temp", "Extr_Min_Temp", "Total_Rain",
    "Total_Snow", "Total_Precip", "Snow_Grnd_Last_Day", "Dir_of_Max_Gust", "Spd_of_Max_Gust",
]
WEATHER = text_schema(
    "REF_DATE", "Year", "Month",
    *[name for value in WEATHER_VALUES for name in (value, f"{value}_Flag")],
)

# Daily rate series.
RATE_VALUES = [
    "1y_fixed_posted", "2y_bond", "3y_bond", "3y_fixed_posted", "5y_bond", "5y_fixed_posted",
    "7y_bond", "10y_bond", "bank", "overnight", "overnight_target", "prime",
]
RATES = text_schema("date", *RATE_VALUES)

# Columns of a scraped listing and those that cleaning adds.
LISTING = text_schema(
    "province", "listprice", "date_added", "locality", "postal_code", "year_built",
    "taxes", "Basement", "Lot_size", "Bed", "Baths", "Area",
)
_CLEAN_TYPES = {
    "listprice": DecimalType(18, 2), "year_built": IntegerType(), "Area": DoubleType(),
    "PriceperSqft": DoubleType(), "Age": IntegerType(), "DateAdd": DateType(),
}
CLEAN_LISTING = StructType([
    StructField(name, _CLEAN_TYPES.get(name, StringType()))
    for name in [*LISTING.names, "monthyr", "PriceperSqft", "Age", "DateAdd"]
])

# The columns of the regional panel, in order.
PANEL_TEXT = [
    "GEO", "REF_DATE", "DGUID", "uom_houseindex", "scalar_houseindex", "uom_income", "scalar_income",
    "statistic_income", "uom_expenditure", "scalar_expenditure", "statistic_expenditure", "uom_tourist",
    "scalar_tourist", "uom_labourforce", "scalar_labourforce", "statistic_labourforce", "uom_lfperc",
    "scalar_lfperc", "statistic_labourforceperc", "uom_crime", "scalar_crime", "statistic_crime",
    "uom_cpi", "scalar_cpi", "uom_oil", "scalar_oil", "uom_imm", "scalar_imm",
]
PANEL_COLUMNS = [
    "GEO", "REF_DATE", "DGUID", "uom_houseindex", "scalar_houseindex", "house_only", "land_only",
    "total_house_land", "uom_income", "scalar_income", "statistic_income", "income", "uom_expenditure",
    "scalar_expenditure", "statistic_expenditure", "food_expenditures", "income_taxes", "mortageinsurance",
    "mortagePaid", "accomodation", "rent", "shelter", "total_expenditure", "taxes_landregfees", "uom_tourist",
    "scalar_tourist", "international_tourism", "domestic_tourism", "uom_labourforce", "scalar_labourforce",
    "statistic_labourforce", "employment", "fulltime", "labourforce", "parttime", "population", "unemployment",
    "uom_lfperc", "scalar_lfperc", "statistic_labourforceperc", "employment_rate", "participationrate",
    "unemployment_rate", "uom_crime", "scalar_crime", "statistic_crime", "crime_incidents", "uom_cpi",
    "scalar_cpi", "cpi_index", "uom_oil", "scalar_oil", "diesel_fillingstations", "diesel_selfservstations",
    "premium_fillingstations", "premium_selfservstations", "regular_fillingstations",
    "regular_selfservstations", "uom_imm", "scalar_imm", "immigrants", *RATE_VALUES,
    "Mean_Max_Temp", "Mean_Min_Temp", "Mean_Temp", "Total_Rain", "Total_Snow",
]
PANEL = StructType([
    StructField(name, StringType() if name in PANEL_TEXT else DoubleType()) for name in PANEL_COLUMNS
])
