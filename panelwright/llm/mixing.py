"""Mixing sources to target weights by a low-discrepancy schedule; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.llm.tables import WORD, read, running
from panelwright.session import landed

#: Words of one block of the schedule.
BLOCK_WORDS = 256
#: Documents of one bucket of a source's shuffled order, and slots of one stripe of the schedule.
BUCKET_DOCS = 20_000
STRIPE_SLOTS = 65_536
#: Times a source may be repeated.
REPEATS = 3

#: Masks that swap neighbouring groups of 1, 2, 4 ... 32 bits: fixed values of the bit reversal.
SWAPS = [
    (1, 0x5555555555555555),
    (2, 0x3333333333333333),
    (4, 0x0F0F0F0F0F0F0F0F),
    (8, 0x00FF00FF00FF00FF),
    (16, 0x0000FFFF0000FFFF),
    (32, 0x00000000FFFFFFFF),
]


def van_der_corput(place: Column, bits: int) -> Column:
    """The ``bits`` low bits of a long in reverse order: 2**bits times the base-2 van der Corput point.

    It is its own inverse, so it also tells the slot whose point falls on a place.
    """
    for shift, mask in SWAPS:
        upper = F.shiftrightunsigned(place, shift).bitwiseAND(F.lit(mask))
        place = upper.bitwiseOR(F.shiftleft(place.bitwiseAND(F.lit(mask)), shift))
    return F.shiftrightunsigned(place, 64 - bits) if bits else F.lit(0).cast("long")


def targets(sized: DataFrame) -> DataFrame:
    """source, source_size, sid (rank by code point, null last) and target of every source.

    Weights are 1, 2, 3, repeating in that rank.  Targets share the words of all
    sources by weight, but none is above ``REPEATS`` times its source: a source
    is held there if its share of what the sources with a smaller ratio of
    limit to weight leave is larger.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = running(sizes, [F.col("source").asc_nulls_last()], {}).withColumnRenamed("place", "sid")
    weighted = by_name.withColumns(
        {"weight": F.col("sid") % 3 + 1, "limit": REPEATS * F.col("source_size")}
    ).withColumn("ratio", F.col("limit") / F.col("weight"))
    filled = landed(running(weighted, [F.col("ratio"), F.col("sid")], {"limits": "limit", "weights": "weight"}), "targets")
    all_words = filled.agg(F.sum("source_size")).scalar()
    all_weights = filled.agg(F.sum("weight")).scalar()
    held = F.col("ratio") <= (all_words - F.col("limits")) / (all_weights - F.col("weights"))
    level = (
        filled.filter(~held)
        .agg(F.min(F.struct("place", ((all_words - F.col("limits")) / (all_weights - F.col("weights"))).alias("level"))).alias("s"))
        .select("s.level")
        .scalar()
    )
    limit = F.col("limit").cast("double")
    return filled.select(
        "source", "source_size", "sid", F.coalesce(F.least(limit, level * F.col("weight")), limit).alias("target")
    )


def shuffled(sized: DataFrame, sources: DataFrame, documents: int, seed: str) -> DataFrame:
    """Every document with ``start``, the words of its source that come before it in a shuffled order.

    The order is that of a hash of the id.  It is cut into buckets by the first
    digits of the hash, so that no task holds a hot source.
    """
    buckets = documents // BUCKET_DOCS + 1
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    keyed = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).select(
        "doc_id", "size", sources["source"], "sid", "source_size", "target", digest.alias("digest")
    )
    leading = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    keyed = keyed.withColumn("bucket", F.shiftrightunsigned(leading * buckets, 32))
    earlier = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = keyed.groupBy("sid", "bucket").agg(F.sum("size").alias("words")).select(
        "sid", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset")
    )
    inside = (
        Window.partitionBy("sid", "bucket").orderBy("digest", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        keyed.withColumns(
            {"inner": F.coalesce(F.sum("size").over(inside), F.lit(0)), "row": F.count(F.lit(1)).over(inside)}
        )
        .join(starts, ["sid", "bucket"])
        .withColumn("start", F.col("offset") + F.col("inner"))
        .select("doc_id", "size", "source", "sid", "bucket", "row", "source_size", "target", "start")
    )


def schedule(sources: DataFrame, block_words: int) -> DataFrame:
    """slot, sid, rank, block, end: the blocks of all sources in the order in which the mix reads them.

    A source gets as many slots as its target has blocks: whole passes over its
    blocks, then one that ends inside a block.  Its slots are those whose van
    der Corput points fall into its part of the cumulative slots; the k-th of
    them reads its block k, counted round.  ``end`` is the word at which the
    slot stops reading.
    """
    words = F.least(F.round("target").cast("long"), REPEATS * F.col("source_size"))
    blocks = F.ceil(F.col("source_size") / block_words)
    planned = (
        sources.filter("source_size > 0")
        .withColumn("words", words)
        .withColumns({"passes": F.expr("words div source_size"), "rest": F.expr("words % source_size"), "blocks": blocks})
        .withColumn("slots", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / block_words))
        .select("sid", "source_size", "passes", "rest", "blocks", "slots")
    )
    placed = landed(running(planned, [F.col("sid")], {"first": "slots"}), "planned")
    total = placed.agg(F.sum("slots")).first()[0] or 0
    bits = max(total - 1, 0).bit_length()
    stripes = placed.filter("slots > 0").select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(slots - 1) div {STRIPE_SLOTS}"))).alias("part")
    )
    places = stripes.repartition("sid", "part").select(
        "*",
        F.explode(
            F.sequence(
                F.col("first") + F.col("part") * STRIPE_SLOTS,
                F.col("first") + F.least((F.col("part") + 1) * STRIPE_SLOTS, F.col("slots")) - 1,
            )
        ).alias("at"),
    )
    slots = places.withColumn("slot", van_der_corput(F.col("at"), bits)).withColumn(
        "stripe", F.expr(f"slot div {STRIPE_SLOTS}")
    )
    earlier = Window.partitionBy("sid").orderBy("stripe").rowsBetween(Window.unboundedPreceding, -1)
    before = slots.groupBy("sid", "stripe").agg(F.count(F.lit(1)).alias("n")).select(
        "sid", "stripe", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    inside = F.row_number().over(Window.partitionBy("sid", "stripe").orderBy("slot"))
    ranked = slots.withColumn("inside", inside).join(before.hint("merge"), ["sid", "stripe"]).withColumn(
        "rank", F.col("before") + F.col("inside") - 1
    )
    block = F.col("rank") % F.col("blocks")
    stop = F.when(F.expr("rank div blocks") == F.col("passes"), F.col("rest")).otherwise(F.col("source_size"))
    return ranked.select(
        "slot", "sid", "rank", block.alias("block"), F.least((block + 1) * block_words, stop).alias("end"),
        F.least((block + 1) * block_words, F.col("source_size")).alias("block_end"),
    )


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id",
        block_words: int = BLOCK_WORDS, seed: str = "mix-1:") -> DataFrame:
    """doc_id, size, source_size, target, taken and source of every document.

    Each source is laid out in a shuffled order and cut into blocks of equal
    words; :func:`schedule` tells which blocks are read and how often, and a
    join of blocks with the documents that lie in them tells the words taken of
    each.  Slots and blocks grow with the words, though they come from the few
    rows of the sources, so their joins are told not to broadcast them.  A
    source's taken words are its target, rounded.  The result depends on the rows
    alone, not on their partitions.

    Null texts and texts without words have size 0 and take nothing; a null
    source is a source of its own; rows with a null or repeated id are mixed as
    rows of their own; no rows give no rows.  Other columns are not read.
    """
    sized = landed(
        docs.select(
            F.col(key).alias("doc_id"),
            F.col(source).alias("source"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "sized",
    )
    sources = landed(targets(sized), "sources")
    laid = landed(shuffled(sized, sources, sized.count(), seed), "laid")
    picks = schedule(sources, block_words).groupBy("sid", "block").agg(
        F.sum((F.col("end") == F.col("block_end")).cast("long")).alias("whole"),
        F.max(F.when(F.col("end") < F.col("block_end"), F.col("end"))).alias("cut"),
    )
    within = F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))
    pieces = laid.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, within)))
    low = F.greatest("start", F.col("block") * block_words)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    words = F.coalesce(F.col("whole"), F.lit(0)) * (high - low) + F.greatest(
        F.least(high, F.col("cut")) - low, F.lit(0).cast("long")
    ) * F.col("cut").isNotNull().cast("long")
    return (
        pieces.join(picks.hint("merge"), ["sid", "block"], "left")
        .withColumn("words", F.coalesce(words, F.lit(0)))
        .groupBy("sid", "bucket", "row", "doc_id", "size", "source_size", "target", "source")
        .agg(F.sum("words").alias("taken"))
        .select("doc_id", "size", "source_size", "target", "taken", "source")
    )


def passes(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mixed documents: one row for each time a document is read, with the columns of ``docs``.

    A pass that ends inside a document keeps its first words, joined by spaces,
    and ``n_chars`` says so.  ``mixed`` is the result of :func:`mix` for these
    rows; rows of one id are told apart by source and size.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
    numbered = lambda size: F.row_number().over(Window.partitionBy("doc_id").orderBy("source", size))
    taken = mixed.withColumn("_n", numbered(F.col("size"))).filter("taken > 0").select(
        F.col("doc_id").alias("_id"), "_n", F.col("size").alias("_size"), F.col("taken").alias("_taken")
    )
    own = docs.withColumn("_own", size).withColumn("_row", numbered(F.col("_own")))
    read_through = own.join(taken, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_n"))).withColumn(
        "_pass", F.explode(F.sequence(F.lit(1).cast("long"), F.expr("(_taken + _size - 1) div _size")))
    )
    words = F.least(F.col("_size"), F.col("_taken") - (F.col("_pass") - 1) * F.col("_size")).cast("int")
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), words), " ")
    text = F.when(words < F.col("_size"), cut).otherwise(F.col("text"))
    return read_through.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).drop("source")


#: The schedule reads every block of a source once per pass and ends inside one pass, so what it takes of a
#: document also has a closed form over the same shuffled order.
OP2_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
named AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, sid % 3 + 1 AS weight, {REPEATS} * source_size AS lim, ({REPEATS} * source_size)::DOUBLE / (sid % 3 + 1) AS ratio
  FROM named),
filled AS (
  SELECT *, coalesce(sum(lim) OVER w, 0) AS limits, coalesce(sum(weight) OVER w, 0) AS weights,
         row_number() OVER (ORDER BY ratio, sid) AS place
  FROM ranked WINDOW w AS (ORDER BY ratio, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM named) - limits)::DOUBLE / ((SELECT sum(weight) FROM ranked) - weights) AS level
  FROM filled),
targets AS (
  SELECT source, source_size, least(lim::DOUBLE, coalesce((SELECT arg_min(level, place) FROM levels WHERE ratio > level)
         * weight, lim::DOUBLE)) AS target
  FROM levels),
laid AS (
  SELECT doc_id, size, source_size, target, least(round(target)::BIGINT, {REPEATS} * source_size) AS words,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), doc_id, size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE (words // source_size) * size
            + greatest(0, least(start + size, words % source_size) - start) END::BIGINT AS taken
FROM laid
"""
