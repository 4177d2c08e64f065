"""The registered queries of the corpus operators, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from panelwright.llm import audit, bpe, dedup, fingerprints, html_text, language, line_rules, lm, mixing, search, toxicity, variants, warc
from panelwright.session import ship


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, run after the executors have this package."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


_ENTRIES = {
    "op1_main_text": (html_text.op1, None),
    "op2_mixing": (mixing.op2, mixing.OP2_SQL),
    "op3_bpe": (bpe.op3, None),
    "op4_top_k": (search.op4, search.OP4_SQL),
    "op5_fingerprints": (fingerprints.op5, None),
    "op6_near_duplicates": (dedup.op6, dedup.OP6_SQL),
    "op7_warc": (warc.op7, warc.OP7_SQL),
    "op8_toxicity": (toxicity.op8, None),
    "op9_lm": (lm.op9, None),
    "op10_language": (language.op10, None),
    "op11_line_rules": (line_rules.op11, line_rules.OP11_SQL),
    "op12_variants": (variants.op12, variants.OP12_SQL),
    "op13_filter_audit": (audit.op13, audit.OP13_SQL),
}

QUERIES = {name: (shipped(query), sql) for name, (query, sql) in _ENTRIES.items()}
