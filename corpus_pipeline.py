"""Corpus pipeline: from raw documents to encoded training documents.

Each stage reads what the stage before it kept, written as Parquet in the shared folder. All but
the last return the columns of documents:

1. quality: documents that the quality rules reject go.
2. near_copies: of each group linked by 5-word shingles at 80 percent, the smallest doc_id stays.
3. personal_data: spans are replaced in the texts.
4. mix: documents are drawn by the target weights, some twice where a source is short.
5. encode: piece ids.

Empty input gives empty output with the same columns. Rows with a null doc_id cannot be told
apart by stages 1 and 2 and stay.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from slotflow.llm import mixing, near, pieces, pii, quality
from slotflow.llm.common import prepare, stage

#: SQL cannot express the PII and encoding stages; tests hold run() against plain versions.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1."""
    return quality.accept(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10."""
    return near.keep_first(docs, size=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3."""
    return pii.sanitise(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5."""
    return mixing.draw(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9."""
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality", quality_rules), ("near_copies", near_copies), ("personal_data", personal_data), ("mix", mix), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
