"""Corpus pipeline: quality rules, toxicity, near-duplicates, source mix,
token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that the
caller writes as Parquet and reads back as the next stage's docs. The first
four return rows of ``docs`` with their columns; the last returns token
counts and digests. ``labels`` in ``sf_dir`` teach the toxicity stage, from
the rows that the other documents of ``sf_dir`` hold.

A stage without rows passes on an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from arrivo.llm import bpe, mixing, quality, simhash, toxicity
from arrivo.llm.common import table
from arrivo.session import cut_lineage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.filter_quality(docs)


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one_each(docs, simhash.SHINGLE_WORDS, simhash.MAX_BITS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document."""
    return bpe.round_trip(docs, public_tokenizers.path(bpe.RANKS))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxic_documents),
    ("simhash_near_dedup", near_duplicates),
    ("mixing", source_mix),
    ("byte_bpe", token_ids),
]

#: Learned scores and tokens have no SQL form; a brute-force test stands in.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
