"""From raw documents to token ids: five stages, each an operator of panelwright.llm."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from panelwright.llm import byte_bpe, exact_dedup, quality_ordinal, simhash_tiles, temperature_mix  # noqa: E402
from panelwright.llm.common import stage, table  # noqa: E402
from panelwright.llm.queries import vocabulary  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps."""
    return quality_ordinal.select_quality(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the largest id."""
    return exact_dedup.drop_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return simhash_tiles.drop_near(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mixture's numbers: left out or repeated by source."""
    return temperature_mix.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's ids and of the bytes that they decode to."""
    return byte_bpe.round_trip(docs, vocabulary())


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("tokens", tokens)]

#: The classifier is trained and the mixture is dealt by hash: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
