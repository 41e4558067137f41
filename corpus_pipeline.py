"""Training corpus pipeline: keep good documents, drop near copies, redact, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from isallobar.llm import packing, pii, quality, shingles
from isallobar.llm.common import settle, table
from isallobar.llm.queries import vocabulary_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject, unchanged."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles (similarity >= 0.8), the one with the smallest doc_id."""
    return shingles.drop_near_duplicates(docs)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by placeholders."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens."""
    return packing.pack_documents(docs, vocabulary_path())


STAGES = [("quality classifier", quality_filter), ("simhash near-dedup", near_dedup), ("pii", redact_pii), ("best-fit packing", pack)]

#: A learned classifier decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; what each keeps is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
