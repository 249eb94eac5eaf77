"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read again.

language      rows whose language is not known with confidence go (chartlens.llm.language)
toxicity      rows that score as toxic go (chartlens.llm.toxicity; labels of the given tables)
near_dedup    one document of each near-duplicate group stays (chartlens.llm.neardup)
mixing        sources are brought to their target weights (chartlens.llm.mixing)
packing       the mix is packed into training sequences (chartlens.llm.packing)

All stages but the last return the columns of ``documents``. A row that the mix
has twice is two rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chartlens.llm import language, mixing, neardup, packing, toxicity
from chartlens.llm.common import table, written


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_known(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language", language_stage),
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: None: tokens, learned scores and language models have no SQL form; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; rows as ``packing.pack`` returns them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
