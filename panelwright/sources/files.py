"""Code sets, weather files, rate series, listings, and a written panel."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, NumericType, StringType, StructField, StructType

from panelwright.functions.dates import is_month
from panelwright.functions.labels import region_of_file
from panelwright.session import landed
from panelwright.sources.schemas import CLEAN_LISTING, CODE_SETS, LISTING, PANEL, RATE_VALUES, RATES, WEATHER, WEATHER_VALUES


def code_set(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """One code set (``scalar``, ``frequency``, ``symbol``, ``uom``, ``classificationType``) of the JSON catalogue."""
    fields = CODE_SETS[kind]
    wrapper = StructType([StructField("object", StructType([StructField(kind, ArrayType(fields))]))])
    catalogue = spark.read.schema(wrapper).option("multiLine", True).json(path)
    return catalogue.select(F.explode(F.col("object")[kind]).alias("entry")).select("entry.*")


def weather_files(spark: SparkSession, path: str) -> DataFrame:
    """Monthly station rows of a directory of ``<Region>_weather.csv`` files, with their region as GEO.

    Headers, station preambles and blank lines are told apart by their first
    column, which is no month.
    """
    rows = spark.read.schema(WEATHER).option("mode", "PERMISSIVE").csv(path)
    return (
        rows.select("*", region_of_file(F.col("_metadata.file_name")).alias("GEO"))
        .where(is_month("REF_DATE"))
        .withColumns({name: F.col(name).try_cast("double") for name in WEATHER_VALUES})
    )


def weather_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`weather_files`, and what is wrong with lines: GEO, file, line, reason, kept.

    Lines are parsed once, into one landed table that both results read.
    ``reason`` is ``no month`` (headers, preambles, garbage), ``fields`` (too few
    or too many) or ``no number`` (a value that is none); a line with a month
    is kept whatever is wrong with it, its bad values as NULL.
    """
    schema = StructType([*WEATHER.fields, StructField("_corrupt", StringType())])
    lines = spark.read.text(path).where(F.trim("value") != "").select(
        F.col("value").alias("line"), F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))).alias("file"),
        F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), {"columnNameOfCorruptRecord": "_corrupt"}).alias("row"),
    )
    wrong = [F.col("row")[c].isNotNull() & (F.col("row")[c] != "") & F.col("row")[c].try_cast("double").isNull() for c in WEATHER_VALUES]
    kept = F.coalesce(is_month(F.col("row")["REF_DATE"]), F.lit(False))
    reason = (
        F.when(~kept, "no month").when(F.col("row")["_corrupt"].isNotNull(), "fields")
        .when(reduce(lambda a, b: a | b, wrong), "no number")
    )
    parsed = landed(
        lines.select(region_of_file(F.col("file")).alias("GEO"), "file", "line", "row", kept.alias("kept"), reason.alias("reason")), "weather"
    )
    rows = parsed.where("kept").select(*[F.col("row")[c].alias(c) for c in WEATHER.names], "GEO").withColumns(
        {name: F.col(name).try_cast("double") for name in WEATHER_VALUES}
    )
    return rows, parsed.where("reason IS NOT NULL").select("GEO", "file", "line", "reason", "kept")


def daily_rates(spark: SparkSession, path: str) -> DataFrame:
    """Daily rate series; lines that do not start with a date are left out."""
    rows = spark.read.schema(RATES).option("mode", "PERMISSIVE").csv(path)
    return rows.where(F.col("date").rlike(r"^\d{4}-\d{2}-\d{2}$")).withColumns(
        {name: F.col(f"`{name}`").try_cast("double") for name in RATE_VALUES}
    )


#: Listings hold free text: quotes are doubled, and quoted fields may hold commas and line breaks.
LISTING_DIALECT = {"quote": '"', "escape": '"', "multiLine": True, "mode": "PERMISSIVE"}


def raw_listings(spark: SparkSession, path: str | list[str], header: bool = True) -> DataFrame:
    """Scraped listings of one or many CSV part files (a directory, a glob or a list), combined.

    A file with line breaks in its fields cannot be split, so one task reads one file.
    """
    return spark.read.schema(LISTING).options(header=header, **LISTING_DIALECT).csv(path)


def clean_listings_file(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned listings as written by :func:`panelwright.sources.sinks.write_listings`."""
    return spark.read.schema(CLEAN_LISTING).options(**LISTING_DIALECT).csv(path)


def panel_schema(by: str = "region") -> StructType:
    """The schema of a written panel, by the columns of its variant."""
    if by == "region":
        return PANEL
    from panelwright.plans.regional_panel import panel_columns

    texts = ("province", "REF_DATE", "uom_", "scalar_", "statistic_")
    return StructType([
        StructField(c, StringType() if c.startswith(texts) else DoubleType()) for c in panel_columns(by)
    ])


def read_panel(spark: SparkSession, path: str, form: str = "parquet", by: str = "region") -> DataFrame:
    """A written panel, typed: Parquet as it is, CSV with the schema of the variant.

    A CSV whose header is not that of the variant is an error, not read by position.
    """
    if form == "parquet":
        return spark.read.parquet(path)
    schema = panel_schema(by)
    header = spark.read.option("header", True).csv(path).columns
    if header != schema.names:
        raise ValueError(f"{path} is no panel by {by}: its columns are {', '.join(header[:4])} ...")
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def keys_and_numbers(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key columns and all numeric columns, in table order."""
    numbers = set(numeric_columns(df))
    return df.select([f"`{c}`" for c in df.columns if c in keys or c in numbers])
