"""Corpus pipeline: language ID, quality rules, near duplicates, personal data, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's
docs. All but the last return the columns of ``documents``; the last returns the
packed pieces. Each stage learns and counts on its own whole input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlens.llm import jaccard_join, lang_id, packing, pii, quality_rules
from marketlens.llm.common import Scratch, small_batches, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognisable language."""
    small_batches(spark)
    return lang_id.keep_recognised(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the weakly supervised rules reject."""
    small_batches(spark)
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of near duplicates."""
    small_batches(spark)
    return jaccard_join.keep_one_per_component(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the texts."""
    small_batches(spark)
    return pii.mask_pii(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenises the texts and packs them into sequences."""
    small_batches(spark)
    return packing.pack(docs)


STAGES = [("language_id", language), ("quality_rules", quality), ("ngram_jaccard_join", near_duplicates), ("pii", personal_data), ("packing", pack)]
#: The stages' models (learned rules, tagger, tokenizer) have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = scratch.put(docs, name)
    return docs
