"""Left-joining features around a region x period spine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.dates import year_of
from panelwright.functions.numbers import monthly_share
from panelwright.operators.reshape import all_not_null, quoted, with_tags
from panelwright.session import landed, scratch_path, settings
from panelwright.sources.sinks import write_bucketed


@dataclass(frozen=True)
class Feature:
    """One source that enriches the spine.

    ``grain`` is ``month`` or ``year`` (an annual row serves every month of its
    year), ``by`` is ``region`` or ``national``.  ``annual`` names the columns
    that hold amounts per year, of which a month gets a twelfth.  ``duplicates``
    says what several rows of one key mean: ``raise`` fails the query, ``mean``
    averages them (text columns take their smallest value), ``unique`` trusts
    that the source was grouped by the key.  ``tags`` are constant columns,
    NULL where the spine finds no row; kept out of the check on duplicates,
    they leave it to a hash aggregation over numbers.
    """

    data: DataFrame
    columns: Sequence[str]
    grain: str = "month"
    by: str = "region"
    annual: Sequence[str] = field(default=())
    duplicates: str = "raise"
    tags: Mapping[str, str] = field(default_factory=dict)


def one_row_per_key(df: DataFrame, keys: Sequence[str], columns: Sequence[str], duplicates: str) -> DataFrame:
    """The table with one row per key, so that a left join on the key cannot fan out.

    The check is part of the plan: it aggregates on the join key, with map-side
    aggregation, and the join reuses that partitioning.
    """
    if duplicates not in ("raise", "mean", "unique"):
        raise ValueError(f"unknown rule for duplicates: {duplicates}")
    kept = df.where(all_not_null(keys)).select(*[quoted(c) for c in [*keys, *columns]])
    if duplicates == "unique":
        return kept
    kinds = dict(kept.dtypes)
    message = F.lit(f"several rows of one key ({', '.join(keys)}) in a feature table")
    merged = []
    for c in columns:
        if duplicates == "raise":
            value = F.when(F.count(F.lit(1)) == 1, F.first(quoted(c))).otherwise(F.raise_error(message))
        elif kinds[c] == "string":
            value = F.min(quoted(c))
        else:
            value = F.avg(quoted(c))
        merged.append(value.alias(c))
    return kept.groupBy(*[quoted(k) for k in keys]).agg(*merged)


def build_panel(
    spine: DataFrame, features: Sequence[Feature], region: str = "DGUID", period: str = "REF_DATE", year: str | None = None
) -> DataFrame:
    """The spine with the columns of every feature; exactly one output row per spine row.

    Periods are matched as they are written, months or any other form.

    Features with the same key are joined next to each other, so the spine is
    shuffled once per kind of key and not once per feature.  Nothing is told to
    be broadcast: Spark does so with what is below its threshold when it is known.

    ``year`` names a column that spine and regional features have, the year of
    their period: it then is part of every regional key, so that tables in buckets
    of region and year are joined where they lie; see :func:`co_located`.
    """
    order = [(g, b) for b in ("region", "national") for g in ("month", "year")]
    for f in features:
        if (f.grain, f.by) not in order:
            raise ValueError(f"unknown grain or scope: {f.grain}, {f.by}")
    own_year, year = year, year or "_panel_year"
    out = spine if own_year else spine.withColumn(year, year_of(period))
    for f in sorted(features, key=lambda f: order.index((f.grain, f.by))):
        data = f.data
        time = period if f.grain == "month" else year
        if time != period:
            held = own_year and f.by == "region"
            data = data.drop(period) if held else data.withColumnRenamed(period, time)
        keys = [time] if f.by == "national" else list(dict.fromkeys([region, *([year] if own_year else []), time]))
        side = one_row_per_key(data, keys, f.columns, f.duplicates)
        if f.annual:
            side = side.withColumns({c: monthly_share(quoted(c)) for c in f.annual})
        if f.tags:
            side = with_tags(side, **f.tags)
        out = out.join(side, keys, "left")
    names = [*spine.columns, *[c for f in features for c in [*f.tags, *f.columns]]]
    return out.select(*[quoted(c) for c in names])


def co_located(
    spine: DataFrame, features: Sequence[Feature], buckets: int, name: str, region: str = "DGUID", period: str = "REF_DATE"
) -> DataFrame:
    """:func:`build_panel` over tables that lie in buckets of region and year, so that regional joins shuffle nothing.

    Spine and regional features are written in the same buckets (of both
    columns, so a region with a third of all rows is spread over its years),
    each by one shuffle.  What a refresh does not change stays in its buckets:
    pass such tables to :func:`build_panel` themselves, with ``year``.  National
    features are joined as ever.  The panel is computed inside, as the planner
    must be told to be content with a part of the join keys.
    """
    spark, year = spine.sparkSession, "_panel_year"

    def stored(df: DataFrame, part: str) -> DataFrame:
        table = f"{name}_{part}"
        write_bucketed(df.withColumn(year, year_of(period)), table, scratch_path(spark, table), [region, year], buckets)
        return spark.table(table)

    own = stored(spine, "spine")
    placed = [
        replace(f, data=stored(f.data.select(*[quoted(c) for c in [region, period, *f.columns]]), f"feature_{i}"))
        if f.by == "region" else f for i, f in enumerate(features)
    ]
    with settings(spark, spark__sql__requireAllClusterKeysForCoPartition="false"):
        return landed(build_panel(own, placed, region, period, year).drop(year), name)
