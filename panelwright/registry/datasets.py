"""The twelve panel sources and the panel itself, over inputs derived from the benchmark tables.

The inputs have the shape of the published statistics: one row per place,
period and category.  Places are nations (``"NATION_3, ASIA"``) and, as
provinces, regions.  Their texts (``_LONG`` ...) run on both engines; the
checked work starts from them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.labels import region_of_file
from panelwright.plans import datasets as d
from panelwright.plans.regional_panel import load_all, panel_columns, regional_panel
from panelwright.registry.support import plain, r, read, tidy
from panelwright.operators.lookups import region_ids
from panelwright.session import landed
from panelwright.sources.schemas import RATE_VALUES

# months are grouped as timestamps and become text afterwards
ORDERS_BY_MONTH = """
SELECT nk, substr(cast(m AS STRING), 1, 7) AS ref_date, o_orderpriority, o_orderstatus, total, n FROM (
  SELECT c_nationkey AS nk, date_trunc('month', o_orderdate) AS m, o_orderpriority, o_orderstatus,
         sum(o_totalprice) AS total, count(*) AS n
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4) q"""
_KINDS = [
    (priority, status)
    for priority in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW") for status in "FOP"
]
_OTHER = "Other|Other|Other|Other|Other"
_MONTH = "ref_date"
_YEAR = "substr(ref_date, 1, 4)"


def _long(categories: Sequence[str], period: str = _MONTH) -> str:
    """A long table with the mean order price per place, period and category, of nations and regions.

    The kinds of orders (priority and status) stand for the categories in
    turn, and for one that no source asks for.  All of these tables start
    from the same aggregation of orders.
    """
    named = [*categories, _OTHER]
    cases = " ".join(
        f"WHEN o_orderpriority = '{priority}' AND o_orderstatus = '{status}' THEN '{named[i % len(named)]}'"
        for i, (priority, status) in enumerate(_KINDS)
    )
    return f"""
WITH base AS (
  SELECT nk, {period} AS ref_date, CASE {cases} ELSE '{_OTHER}' END AS category, sum(total) AS total, sum(n) AS n
  FROM {{orders_by_month}} GROUP BY 1, 2, 3)
SELECT ref_date AS REF_DATE,
       CASE WHEN nk = 3 THEN 'Ottawa-Gatineau, Quebec part, Ontario/Quebec' ELSE n_name || ', ' || r_name END AS GEO,
       '2016A' || cast(nk AS STRING) AS DGUID, category, total / n AS VALUE, r_regionkey AS UOM_ID, r_regionkey AS SCALAR_ID
FROM base JOIN {{nation}} ON nk = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey
UNION ALL
SELECT ref_date, r_name, '2016P' || cast(r_regionkey AS STRING), category, sum(total) / sum(n), r_regionkey, r_regionkey
FROM base JOIN {{nation}} ON nk = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey
GROUP BY ref_date, r_name, r_regionkey, category"""


_INCOME = [
    "Both sexes|All age groups|5-year percent change of median income",
    "Both sexes|All age groups|Median total income",
    "Males|All age groups|Median total income",
]
_LABOUR = [f"{name}|Both sexes|Estimate|Seasonally adjusted|15 years and over" for name in [*d.LABOUR_COUNTS, *d.LABOUR_RATES]]
_LABOUR += ["Employment|Both sexes|Estimate|Seasonally adjusted|25 to 54 years", "Employment|Males|Estimate|Unadjusted|Total"]
_CRIME = [f"Total, all violations|{m}" for m in d.CRIME_MEASURE.values()] + ["Total theft|Actual incidents"]

_INPUTS = {
    "housing": _long(list(d.HOUSING)),
    "income": _long(_INCOME, _YEAR),
    "expenditure": _long([*d.EXPENDITURE, *d.EDUCATION], _YEAR),
    "tourism": _long(list(d.TOURISM)),
    "labour": _long(_LABOUR),
    "crime": _long(_CRIME, _YEAR),
    "fuel": _long(list(d.FUEL)),
    "migration": _long(list(d.MIGRATION)),
    "immigrants": _long(list(d.IMMIGRANTS)),
    "cpi": f"""SELECT substr(cast(m AS STRING), 1, 7) AS REF_DATE, 'Canada' AS GEO,
  CASE l_returnflag WHEN 'A' THEN '{d.CPI_MEASURE["region"]}' WHEN 'N' THEN '{d.CPI_MEASURE["province"]}'
    ELSE 'Other' END AS category, VALUE
FROM (SELECT date_trunc('month', l_shipdate) AS m, l_returnflag, avg(l_tax) AS VALUE
  FROM {{lineitem}} GROUP BY 1, 2) q""",
    "rates": "SELECT cast(day AS STRING) AS d, c0, c1, c2, c3, c4, c5, c6, c7, c8, c9, c10, c11 FROM ("
    "SELECT cast(l_shipdate AS DATE) AS day, " + ", ".join(
        f"{f}({c}) AS c{i}" for i, (f, c) in enumerate(
            (f, c) for f in ("avg", "min", "max") for c in ("l_discount", "l_tax", "l_quantity", "l_extendedprice")
        )
    ) + " FROM {lineitem} GROUP BY 1) q",
    "weather": """
WITH base AS (
  SELECT date_trunc('month', l_shipdate) AS m, s_nationkey AS nk, max(l_quantity) AS a,
         min(l_discount) AS b, max(l_tax) AS c, min(l_extendedprice) AS d, max(l_extendedprice) AS e
  FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey GROUP BY 1, 2),
places AS (
  SELECT substr(cast(m AS STRING), 1, 7) AS REF_DATE, '/weather/' || r_name || '_weather.csv' AS file_name,
         max(a) AS Mean_Max_Temp, min(b) AS Mean_Min_Temp, max(c) AS Mean_Temp, min(d) AS Total_Rain, max(e) AS Total_Snow
  FROM base JOIN {nation} ON nk = n_nationkey JOIN {region} ON n_regionkey = r_regionkey GROUP BY m, r_name)
SELECT * FROM places UNION ALL SELECT * FROM places""",
    "uom": "SELECT n_nationkey AS memberUomCode, 'Index, 201612=' || cast(100 + n_nationkey AS STRING) AS memberUomEn FROM {nation}",
    "scalar": "SELECT r_regionkey AS scalarFactorCode, r_name || ' ' AS scalarFactorDescEn FROM {region}",
}


def _split(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The parts of ``category`` as columns."""
    parts = F.split("category", r"\|")
    return df.withColumns({name: F.get(parts, F.lit(i)) for i, name in enumerate(names)}).drop("category")


_CATEGORY = {
    "housing": ["New housing price indexes"],
    "income": ["Sex", "Age group", "Persons with income"],
    "expenditure": ["Household expenditures, summary-level categories"],
    "tourism": ["Traveller characteristics"],
    "labour": ["Labour force characteristics", "Sex", "Statistics", "Data type", "Age group"],
    "crime": ["Violations", "Statistics"],
    "fuel": ["Type of fuel"],
    "migration": ["Interprovincial migration"],
    "immigrants": ["Components of population growth"],
    "cpi": ["Alternative measures"],
}


def tables(spark: SparkSession, sf_dir: str, names: Sequence[str]) -> dict[str, DataFrame]:
    known = {t: read(spark, sf_dir, t) for t in ("nation", "region", "orders", "customer", "lineitem", "supplier")}
    if any("{orders_by_month}" in _INPUTS[name] for name in names):
        # each input reads this table twice, and a panel has nine of them: pass over the orders once
        known["orders_by_month"] = landed(
            spark.sql(ORDERS_BY_MONTH, orders=known["orders"], customer=known["customer"])
        )
    out = {}
    for name in names:
        df = spark.sql(_INPUTS[name], **{t: v for t, v in known.items() if f"{{{t}}}" in _INPUTS[name]})
        if name in _CATEGORY:
            df = _split(df, _CATEGORY[name])
        if name == "crime":
            df = df.withColumn("GEO", F.concat("GEO", F.lit(" ["), "UOM_ID", F.lit("]")))
        if name == "rates":
            df = df.toDF("date", *RATE_VALUES)
        if name == "weather":
            df = df.withColumn("GEO", region_of_file("file_name")).drop("file_name")
        out[name] = df
    return out


# ---- the same in SQL -------------------------------------------------------

_REWRITE = "replace(GEO, 'Ottawa-Gatineau, Quebec part, Ontario/Quebec', 'Ottawa,Quebec')"
_TAIL = "trim(split_part(GEO, ',', -1))"
_PROVINCE = f"trim(split_part({_REWRITE}, ',', -1))"


def _cte(*names: str) -> str:
    inputs = [f"{n}_in AS ({plain(_INPUTS[n])})" for n in names]
    return "WITH " + ", ".join([f"orders_by_month AS ({plain(ORDERS_BY_MONTH)})", *inputs])


def _means(names: Mapping[str, str]) -> str:
    return ", ".join(f"avg(CASE WHEN category = '{c}' THEN VALUE END) AS \"{n}\"" for c, n in names.items())


def _pivot(table: str, names: Mapping[str, str], keys: str = "REF_DATE, GEO, DGUID", where: str = "true") -> str:
    listed = ", ".join(f"'{c}'" for c in names)
    return f"SELECT {keys}, {_means(names)} FROM {table}_in WHERE category IN ({listed}) AND {where} GROUP BY {keys}"


def _q(columns: Sequence[str]) -> str:
    return ", ".join(f'"{c}"' for c in columns)


def _tags(**tags: str) -> str:
    return ", ".join(f"'{v}' AS {k}" for k, v in tags.items())


def _avgs(columns: Sequence[str], rename: bool = True) -> str:
    return ", ".join(f'avg("{c}") AS "{d.avg_name(c) if rename else c}"' for c in columns)


_UNITS = "trim(memberUomEn) AS uom_houseindex, trim(scalarFactorDescEn) AS scalar_houseindex"
_CODES = "JOIN uom_in ON UOM_ID = memberUomCode JOIN scalar_in ON SCALAR_ID = scalarFactorCode"
_EXPENDITURE_TAGS = _tags(**d.EXPENDITURE_TAGS)
_LABOUR_TAGS = _tags(**d.LABOUR_TAGS)
_LABOUR_NAMES = {**d.LABOUR_COUNTS, **d.LABOUR_RATES}


def _sql(name: str, by: str) -> str:
    """The dataset as SQL over the ``*_in`` tables, unrounded."""
    region = by == "region"
    keys = "REF_DATE, GEO, DGUID" if region else "REF_DATE, GEO"
    if name == "housing":
        wide = f"SELECT * FROM ({_pivot('housing', d.HOUSING, keys + ', UOM_ID, SCALAR_ID')}) {_CODES}"
        if region:
            return f"""SELECT trim(GEO) AS GEO, trim(DGUID) AS DGUID, trim(REF_DATE) AS REF_DATE, {_UNITS},
                {_avgs(list(d.HOUSING.values()), False)} FROM ({wide}) GROUP BY 1, 2, 3, 4, 5"""
        return f"""SELECT {_PROVINCE} AS province, trim(REF_DATE) AS REF_DATE, {_UNITS},
            {_avgs(list(d.HOUSING.values()))} FROM ({wide}) GROUP BY 1, 2, 3, 4"""
    if name == "income":
        measure = d.INCOME_MEASURE[by]
        kept = f"SELECT * FROM income_in {_CODES} WHERE category = 'Both sexes|All age groups|{measure}'"
        units = "memberUomEn AS uom_income, scalarFactorDescEn AS scalar_income"
        if region:
            return f"""SELECT GEO, DGUID, REF_DATE, {units}, '{measure}, Both sexes, All age groups' AS statistic_income,
                VALUE AS income FROM ({kept})"""
        return f"""SELECT {_TAIL} AS province, REF_DATE, {units}, avg(VALUE) AS avg_income,
            '{measure},Both sexes,All age groups' AS statistic_income FROM ({kept}) GROUP BY 1, 2, 3, 4"""
    if name == "expenditure":
        if region:
            return f"SELECT *, {_EXPENDITURE_TAGS} FROM ({_pivot(name, {**d.EXPENDITURE, **d.EDUCATION})})"
        return f"""SELECT GEO AS province, REF_DATE, {_avgs(list(d.EXPENDITURE.values()))}, {_EXPENDITURE_TAGS}
            FROM ({_pivot(name, d.EXPENDITURE, keys)}) GROUP BY 1, 2"""
    if name == "tourism":
        tags = _tags(**d.TOURISM_TAGS)
        wide = _pivot(name, d.TOURISM, keys)
        if region:
            return f"SELECT *, {tags} FROM ({wide})"
        return f"SELECT {_TAIL} AS province, REF_DATE, {_avgs(list(d.TOURISM.values()))}, {tags} FROM ({wide}) GROUP BY 1, 2"
    if name == "labour":
        kept = """SELECT * REPLACE (split_part(category, '|', 1) AS category) FROM labour_in
            WHERE category LIKE '%|Both sexes|Estimate|Seasonally adjusted|%'"""
        wide = _pivot(name, _LABOUR_NAMES, keys).replace("labour_in", f"({kept})")
        if region:
            return f"SELECT *, {_LABOUR_TAGS} FROM ({wide})"
        return f"SELECT GEO AS province, REF_DATE, {_avgs(list(_LABOUR_NAMES.values()))}, {_LABOUR_TAGS} FROM ({wide}) GROUP BY 1, 2"
    if name == "crime":
        measure = d.CRIME_MEASURE[by]
        tags = _tags(**d.crime_tags(by))
        kept = f"""SELECT * REPLACE (GEO || ' [' || UOM_ID || ']' AS GEO) FROM crime_in
            WHERE category = 'Total, all violations|{measure}'"""
        if region:
            return f"SELECT GEO, REF_DATE, DGUID, VALUE AS crime_incidents, {tags} FROM ({kept})"
        label = "regexp_replace(trim(split_part(GEO, ',', -1)), ' *\\[[^\\]]*\\]$', '')"
        return f"SELECT {label} AS province, REF_DATE, avg(VALUE) AS avg_crime_incidents, {tags} FROM ({kept}) GROUP BY 1, 2"
    if name == "cpi":
        wide = _pivot(name, {d.CPI_MEASURE[by]: "cpi_index"}, "REF_DATE, GEO")
        tags = _tags(**d.cpi_tags(by))
        if region:
            return f"SELECT *, {tags} FROM ({wide})"
        return f"SELECT GEO AS province, REF_DATE, avg(cpi_index) AS avg_cpi_index, {tags} FROM ({wide}) GROUP BY 1, 2"
    if name == "fuel":
        prices = list(d.FUEL.values())
        tags = _tags(**d.fuel_tags(by))
        wide = _pivot(name, d.FUEL, keys)
        if not region:
            return f"SELECT {_PROVINCE} AS province, REF_DATE, {_avgs(prices)}, {tags} FROM ({wide}) GROUP BY 1, 2"
        return f"""SELECT *, {tags} FROM (
            WITH wide AS ({wide}),
            ids AS (SELECT DISTINCT GEO, DGUID FROM housing_in),
            means AS (SELECT REF_DATE, {_PROVINCE} AS GEO, {_avgs(prices, False)} FROM wide GROUP BY 1, 2)
            SELECT REF_DATE, GEO, DGUID, {_q(prices)} FROM wide
            UNION ALL
            SELECT REF_DATE, GEO, DGUID, {_q(prices)} FROM means JOIN ids USING (GEO)
            WHERE (DGUID, REF_DATE) NOT IN (SELECT (DGUID, REF_DATE) FROM wide))"""
    if name in ("migration", "immigrants"):
        names = d.MIGRATION if name == "migration" else d.IMMIGRANTS
        tags = _tags(**(d.MIGRATION_TAGS if name == "migration" else d.IMMIGRANTS_TAGS))
        wide = _pivot(name, names, keys)
        if region:
            return f"SELECT *, {tags} FROM ({wide})"
        return f"SELECT GEO AS province, REF_DATE, {_avgs(list(names.values()))}, {tags} FROM ({wide}) GROUP BY 1, 2"
    if name == "rates":
        rename = (lambda c: c) if region else d.avg_name
        columns = ", ".join(f'avg(c{i}) AS "{rename(c)}"' for i, c in enumerate(RATE_VALUES))
        return f"SELECT substr(d, 1, 7) AS REF_DATE, {columns} FROM rates_in GROUP BY 1"
    if name == "weather":
        place = "split_part(split_part(file_name, '/', -1), '_', 1)"
        rows = f"SELECT DISTINCT {place} AS GEO, REF_DATE, {_q(d.WEATHER)} FROM weather_in"
        if not region:
            return f"SELECT GEO AS province, REF_DATE, {_q(d.WEATHER)} FROM ({rows})"
        return f"""SELECT GEO, REF_DATE, {_q(d.WEATHER)}, DGUID
            FROM ({rows}) JOIN (SELECT DISTINCT GEO, DGUID FROM housing_in) USING (GEO)"""
    raise ValueError(name)


_NEEDS = {
    "housing": ["housing", "uom", "scalar"],
    "income": ["income", "uom", "scalar"],
    "fuel": ["fuel", "housing"],
    "weather": ["weather", "housing"],
}
_DATASETS = [
    "housing", "income", "expenditure", "tourism", "labour", "crime", "cpi", "fuel", "migration",
    "immigrants", "rates", "weather",
]
_BUILDERS: dict[str, Callable[..., DataFrame]] = {
    "housing": lambda t, by: d.housing(t["housing"], t["uom"], t["scalar"], by),
    "income": lambda t, by: d.income(t["income"], t["uom"], t["scalar"], by),
    "expenditure": lambda t, by: d.expenditure(t["expenditure"], by),
    "tourism": lambda t, by: d.tourism(t["tourism"], by),
    "labour": lambda t, by: d.labour(t["labour"], by),
    "crime": lambda t, by: d.crime(t["crime"], by),
    "cpi": lambda t, by: d.cpi(t["cpi"], by),
    "fuel": lambda t, by: d.fuel(t["fuel"], region_ids(t["housing"]), by),
    "migration": lambda t, by: d.migration(t["migration"], by),
    "immigrants": lambda t, by: d.immigrants(t["immigrants"], by),
    "rates": lambda t, by: d.rates(t["rates"], by),
    "weather": lambda t, by: d.weather(t["weather"], region_ids(t["housing"]), by),
}


def _dataset(name: str, by: str):
    needs = _NEEDS.get(name, [name])
    values = {
        "housing": list(d.HOUSING.values()),
        "income": ["income"],
        "expenditure": [*d.EXPENDITURE.values(), *(["education"] if by == "region" else [])],
        "tourism": list(d.TOURISM.values()),
        "labour": list(_LABOUR_NAMES.values()),
        "crime": ["crime_incidents"],
        "cpi": ["cpi_index"],
        "fuel": list(d.FUEL.values()),
        "migration": list(d.MIGRATION.values()),
        "immigrants": list(d.IMMIGRANTS.values()),
        "rates": RATE_VALUES,
        "weather": d.WEATHER,
    }[name]
    if by == "province" and name != "weather":
        values = [d.avg_name(v) for v in values]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tidy(_BUILDERS[name](tables(spark, sf_dir, needs), by))

    rounded = ", ".join(f"{r(chr(34) + v + chr(34))} AS \"{v}\"" for v in values)
    return query, f"{_cte(*needs)} SELECT * REPLACE ({rounded}) FROM ({_sql(name, by)})"


def _panel(by: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tidy(regional_panel(load_all(tables(spark, sf_dir, list(_INPUTS)), by), by))

    region = by == "region"
    name = (lambda c: c) if region else d.avg_name
    key = "DGUID" if region else "province"
    annual = {name(c) for c in ["income", "crime_incidents", *d.EXPENDITURE.values()]}
    flow = f'm."{name("in_migrants")}" + i."{name("immigrants")}" - m."{name("out_migrants")}"'
    texts = {"GEO", "DGUID", "REF_DATE", "province"}
    columns = []
    for c in panel_columns(by):
        if c == name("immigrants"):
            columns.append(f'{r(flow)} AS "{c}"')
        elif c in annual:
            columns.append(f'{r(f"{chr(34)}{c}{chr(34)} / 12.0", 2)} AS "{c}"')
        elif c in texts:
            columns.append(f'h."{c}"')
        elif c.startswith(("uom_", "scalar_", "statistic_")):
            columns.append(f'"{c}"')
        else:
            columns.append(f'{r(chr(34) + c + chr(34))} AS "{c}"')
    same = f'h."{key}" = {{0}}."{key}" AND h.REF_DATE = {{0}}.REF_DATE'
    year = f'h."{key}" = {{0}}."{key}" AND substr(h.REF_DATE, 1, 4) = {{0}}.REF_DATE'
    joins = [
        ("income", "inc", year, _sql("income", by)), ("expenditure", "e", year, _sql("expenditure", by)),
        ("tourism", "t", same, _sql("tourism", by)), ("labour", "l", same, _sql("labour", by)),
        ("crime", "c", year, _sql("crime", by)), ("cpi", "p", "h.REF_DATE = {0}.REF_DATE", _sql("cpi", by)),
        ("fuel", "o", same, _sql("fuel", by)), ("migration", "m", same, _sql("migration", by)),
        ("immigrants", "i", same, _sql("immigrants", by)), ("rates", "x", "h.REF_DATE = {0}.REF_DATE", _sql("rates", by)),
        ("weather", "w", same, _sql("weather", by)),
    ]
    body = " ".join(f"LEFT JOIN ({sql}) {a} ON {on.format(a)}" for _, a, on, sql in joins)
    return query, f"{_cte(*_INPUTS)} SELECT {', '.join(columns)} FROM ({_sql('housing', by)}) h {body}"


QUERIES = {f"dataset_{n}": _dataset(n, "region") for n in _DATASETS}
QUERIES |= {f"dataset_{n}_province": _dataset(n, "province") for n in _DATASETS}
QUERIES["regional_panel"] = _panel("region")
QUERIES["regional_panel_province"] = _panel("province")
