"""Listings derived from the part table: cleaning and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.operators import extremes as x
from panelwright.plans import listings as p
from panelwright.registry.support import derived, plain, r, read, tidy
from panelwright.session import scratch_path
from panelwright.sources import files, sinks
from panelwright.sources.schemas import LISTING

# raw listing texts, in a form that both engines accept
_RAW = """
SELECT p_partkey AS id, CASE WHEN p_size < 50 THEN p_type END AS province,
  '$ ' || CASE WHEN p_retailprice >= 1000
      THEN cast(cast(floor(p_retailprice / 1000) AS INT) AS STRING) || ',' ||
           lpad(cast(cast(floor(p_retailprice) AS INT) % 1000 AS STRING), 3, '0')
      ELSE cast(cast(floor(p_retailprice) AS INT) AS STRING) END
    || '.' || lpad(cast(cast(round(p_retailprice * 100) AS BIGINT) % 100 AS STRING), 2, '0') AS listprice,
  cast(1 + p_partkey % 28 AS STRING) || '-' ||
    substr('JanFebMarAprMayJunJulAugSepOctNovDec', cast(1 + 3 * (p_partkey % 12) AS INT), 3) || '-' ||
    cast(10 + p_partkey % 9 AS STRING) AS date_added,
  CASE WHEN p_size <> 3 THEN p_brand END AS locality,
  'V' || cast(p_partkey % 10 AS STRING) AS postal_code,
  CASE WHEN p_size >= 5 THEN cast(1975 + p_size AS STRING) END AS year_built,
  '$' || cast(p_size AS STRING) AS taxes, p_name AS Basement, cast(p_size AS STRING) || ' acres' AS Lot_size,
  CASE WHEN p_size <= 40 THEN cast(1 + p_size % 12 AS STRING) END AS Bed,
  CASE WHEN p_size > 5 THEN cast(1 + p_size % 14 AS STRING) END AS Baths,
  CASE WHEN p_size BETWEEN 10 AND 15 THEN NULL WHEN p_size > 25 THEN '1,' || lpad(cast(p_size AS STRING), 3, '0')
    ELSE cast(p_size * 20 AS STRING) END AS Area
FROM {part}"""


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, _RAW)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.clean_listings(raw_listings(spark, sf_dir).select(*LISTING.names))


_CLEAN = f"""raw AS ({plain(_RAW)}),
typed AS (
  SELECT id, province, try_cast(replace(substr(listprice, 3), ',', '') AS DECIMAL(18,2)) AS listprice, date_added,
    locality, postal_code, least(coalesce(try_cast(year_built AS INTEGER), 2018), 2018) AS year_built, taxes,
    "Basement", "Lot_size", "Bed", "Baths", try_cast(replace("Area", ',', '') AS DOUBLE) AS area0,
    split_part(date_added, '-', 2) || split_part(date_added, '-', 3) AS monthyr,
    try_strptime(date_added, '%-d-%b-%y')::DATE AS "DateAdd"
  FROM raw WHERE province IS NOT NULL AND listprice IS NOT NULL AND date_added IS NOT NULL),
clean AS (
  SELECT *, coalesce(area0, (SELECT avg(area0) FROM typed)) AS "Area",
    listprice::DOUBLE / coalesce(area0, (SELECT avg(area0) FROM typed)) AS "PriceperSqft", 2018 - year_built AS "Age"
  FROM typed)"""


def listing_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(clean(spark, sf_dir))


_LISTING_CLEAN = f"""WITH {_CLEAN}
SELECT province, listprice::DOUBLE AS listprice, date_added, locality, postal_code, year_built, taxes, "Basement",
  "Lot_size", "Bed", "Baths", {r('"Area"')} AS "Area", monthyr, {r('"PriceperSqft"')} AS "PriceperSqft", "Age", "DateAdd"
FROM clean"""


def price_range_by_beds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(p.price_range(clean(spark, sf_dir), "Bed"))


def price_range_by_baths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(p.price_range(clean(spark, sf_dir), "Baths"))


def _range_sql(by: str) -> str:
    return f"""WITH {_CLEAN} SELECT max(listprice)::DOUBLE AS maxprice, min(listprice)::DOUBLE AS minprice, "{by}"
FROM clean WHERE "{by}" IS NOT NULL GROUP BY "{by}" ORDER BY try_cast("{by}" AS DOUBLE)"""


def province_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(p.province_summary(clean(spark, sf_dir).withColumn("listprice", F.col("listprice").cast("double"))))


_PROVINCE_SUMMARY = f"""WITH {_CLEAN} SELECT province, max(listprice)::DOUBLE AS maxprice,
  min(listprice)::DOUBLE AS minprice, {r('avg(listprice::DOUBLE)')} AS avgprice FROM clean GROUP BY province"""


def region_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read(spark, sf_dir, "part").select("p_type", "p_retailprice")
    return tidy(x.summary(parts, "p_type", "p_retailprice"))


def _extreme(how: str, by_value_only: bool):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = p.extreme_listings(clean(spark, sf_dir), how, by_value_only)
        counted = [f"{how}_groups"] if by_value_only else []
        return tidy(rows.select("province", "listprice", "locality", "postal_code", "Bed", f"{how}price", *counted))

    if by_value_only:
        return query, f"""WITH {_CLEAN}, m AS (SELECT p, count(*) AS n FROM (
  SELECT {how}(listprice) AS p FROM clean GROUP BY province) GROUP BY p)
SELECT c.province, c.listprice::DOUBLE AS listprice, c.locality, c.postal_code, c."Bed", m.p::DOUBLE AS {how}price,
  m.n AS {how}_groups FROM clean c JOIN m ON c.listprice = m.p"""
    match = "c.listprice = m.p AND c.province = m.province"
    sql = f"""WITH {_CLEAN}, m AS (SELECT province, {how}(listprice) AS p FROM clean GROUP BY province)
SELECT c.province, c.listprice::DOUBLE AS listprice, c.locality, c.postal_code, c."Bed", m.p::DOUBLE AS {how}price
FROM clean c JOIN m ON {match}"""
    return query, sql


def _extreme_parts(how: str, by_value_only: bool):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        parts = read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
        rows = x.extremes_by_value if by_value_only else x.extremes
        counted = [f"{how}_groups"] if by_value_only else []
        return rows(parts, "p_type", "p_size", how).select("p_partkey", "p_type", "p_size", *counted)

    if by_value_only:
        return query, f"""WITH m AS (SELECT v, count(*) AS n FROM (SELECT {how}(p_size) AS v FROM part GROUP BY p_type) GROUP BY v)
SELECT p_partkey, p_type, p_size, m.n AS {how}_groups FROM part JOIN m ON p_size = m.v"""
    match = "p.p_size = m.v AND p.p_type = m.p_type"
    sql = f"""WITH m AS (SELECT p_type, {how}(p_size) AS v FROM part GROUP BY p_type)
SELECT p_partkey, p.p_type, p_size FROM part p JOIN m ON {match}"""
    return query, sql


def top_locality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(p.most_expensive_localities(clean(spark, sf_dir)))


_TOP_LOCALITY = f"""WITH {_CLEAN},
known AS (SELECT * FROM clean WHERE locality IS NOT NULL),
a AS (SELECT locality, {r('avg("PriceperSqft")', 8)} AS avgprice FROM known GROUP BY locality),
b AS (SELECT k.province, k.postal_code, a.avgprice, a.locality FROM known k JOIN a ON k.locality = a.locality),
m AS (SELECT province, max(avgprice) AS maxprice FROM b GROUP BY province)
SELECT DISTINCT b.locality, b.postal_code, m.province, {r('m.maxprice')} AS maxprice
FROM m JOIN b ON m.province = b.province AND m.maxprice = b.avgprice"""


def top_locality_value_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(p.most_expensive_localities(clean(spark, sf_dir), by_value_only=True))


_TOP_VALUE_ONLY = _TOP_LOCALITY[: _TOP_LOCALITY.index("SELECT DISTINCT")] + f"""
SELECT DISTINCT locality, postal_code, province, {r('avgprice')} AS maxprice FROM b
WHERE avgprice IN (SELECT maxprice FROM m)"""


# raw listings with commas, quotes and line breaks in their fields
_ODD = f"""SELECT id, province, listprice, date_added, locality || '\n"' || postal_code || '", ' || taxes AS locality, postal_code,
  year_built, taxes, Basement, Lot_size || '" x 120", deep' AS Lot_size, Bed, Baths, Area FROM ({_RAW})"""


def listing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headed CSV part files as a scraper writes them, combined."""
    path = scratch_path(spark, "listings")
    odd = derived(spark, sf_dir, _ODD).select(*LISTING.names)
    odd.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return p.combine_listings(spark, path)


def listing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned listings written by the sink and read again."""
    path = scratch_path(spark, "listings")
    sinks.write_listings(p.clean_listings(derived(spark, sf_dir, _ODD).select(*LISTING.names)), path)
    return tidy(files.clean_listings_file(spark, path))


_ODD_COLUMNS = {"locality": """locality || '\n"' || postal_code || '", ' || taxes""", '"Lot_size"': """"Lot_size" || '" x 120", deep'"""}
_LISTING_SCAN = f"""SELECT {', '.join(f'{_ODD_COLUMNS.get(c, c)} AS {c}' for c in [f'"{n}"' if n[0].isupper() else n for n in LISTING.names])}
FROM ({plain(_RAW)})"""
_LISTING_ROUNDTRIP = f"""SELECT * REPLACE ({', '.join(f'{v} AS {c}' for c, v in _ODD_COLUMNS.items())}) FROM ({_LISTING_CLEAN})"""


def age_price_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(p.age_price_correlation(clean(spark, sf_dir)), 8)


_CORR = f"""WITH {_CLEAN}, c AS (SELECT corr("Age"::DOUBLE, listprice::DOUBLE) AS v FROM clean)
SELECT {r('v', 8)} AS r, {r('v * v', 8)} AS r_squared FROM c"""


def corr_of_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read(spark, sf_dir, "part").select("p_size", "p_retailprice")
    return tidy(x.correlation_of_moments(x.moments(parts, "p_size", "p_retailprice")), 6)


_CORR_MOMENTS = f"""WITH m AS (
  SELECT count(*) AS n, sum(p_size::DOUBLE) AS sx, sum(p_retailprice) AS sy, sum(p_size::DOUBLE * p_size) AS sxx,
         sum(p_retailprice * p_retailprice) AS syy, sum(p_size * p_retailprice) AS sxy FROM part),
c AS (SELECT (n * sxy - sx * sy) / (sqrt(n * sxx - sx * sx) * sqrt(n * syy - sy * sy)) AS v FROM m)
SELECT {r('v', 6)} AS r, {r('v * v', 6)} AS r_squared FROM c"""


QUERIES = {
    "listing_clean": (listing_clean, _LISTING_CLEAN),
    "price_range_by_beds": (price_range_by_beds, _range_sql("Bed")),
    "price_range_by_baths": (price_range_by_baths, _range_sql("Baths")),
    "province_summary": (province_summary, _PROVINCE_SUMMARY),
    "region_summary": (
        region_summary,
        "SELECT p_type, max(p_retailprice) AS max_p_retailprice, min(p_retailprice) AS min_p_retailprice, "
        f"{r('avg(p_retailprice)')} AS avg_p_retailprice FROM part GROUP BY p_type",
    ),
    "extreme_rows": _extreme_parts("max", False),
    "extreme_rows_min": _extreme_parts("min", False),
    "extreme_rows_value_only": _extreme_parts("max", True),
    "extreme_rows_value_only_min": _extreme_parts("min", True),
    "extreme_listings": _extreme("max", False),
    "cheapest_listings": _extreme("min", False),
    "extreme_listings_value_only": _extreme("max", True),
    "top_locality": (top_locality, _TOP_LOCALITY),
    "top_locality_value_only": (top_locality_value_only, _TOP_VALUE_ONLY),
    "listing_scan": (listing_scan, _LISTING_SCAN),
    "listing_roundtrip": (listing_roundtrip, _LISTING_ROUNDTRIP),
    "age_price_corr": (age_price_corr, _CORR),
    "corr_of_moments": (corr_of_moments, _CORR_MOMENTS),
}
