"""From raw documents to tokens: toxicity, language, near duplicates, mixing and encoding, one Spark job after the other.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns
a DataFrame; all but the last keep the columns of ``documents``.  :func:`run`
writes each stage's result into the shared folder and reads it back.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from panelwright.llm import bpe, dedup, language, mixing, toxicity
from panelwright.llm.tables import crc_mod, read
from panelwright.session import landed, ship


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that are predicted toxic by a model of the labels that are not held out.

    Where these labels tell no class from the other, nothing is dropped.
    """
    ship(spark)
    model = toxicity.learned(docs, read(spark, sf_dir, "labels"))
    if not model.weights:
        return docs
    return toxicity.score(docs, model).filter("predicted = 0").select(docs.columns)


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose language cannot be told: null texts and those without a letter."""
    ship(spark)
    langs, vectors = language.prototypes(docs.filter(crc_mod("doc_id", 4) != 2).select("text", "lang"))
    if not langs:
        # one language for all texts with a letter
        langs, vectors = ["any"], np.zeros((1, language.DIMENSIONS))
    return language.identify(docs, langs, vectors).filter(f"lang_pred <> '{language.UNDETERMINED}'").select(docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 or more of its five-word shingles, the one with the smallest id."""
    ship(spark)
    return dedup.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of their sources reads them; a pass that ends inside one keeps its first words."""
    return mixing.passes(docs, mixing.mix(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text of every row."""
    ship(spark)
    return bpe.encoded_documents(docs)


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("language", in_a_language),
    ("near_duplicates", without_near_duplicates),
    ("mixing", mixed),
    ("bpe", tokens),
]

#: Models, tokens and hashes are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage for the table ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), name)
    return docs
