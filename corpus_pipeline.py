"""From raw documents to packed training sequences.

Each stage takes all rows that the stage before it kept, and all but the last
return the columns of documents. Null texts have no words, so the quality rules
reject them; every later stage would take them as empty texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltwork.llm import mixing, near_duplicates, packing, personal_data, quality
from siltwork.llm.registry import ship
from siltwork.session import write_out


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.passing(docs)


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates."""
    ship(spark)
    return near_duplicates.deduplicated(docs, size=5, threshold=0.8)


def personal_data_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return personal_data.redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeated(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    ship(spark)
    return packing.packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicate_groups),
    ("personal_data", personal_data_redaction),
    ("source_mix", source_mix),
    ("packing", packed_sequences),
]
#: Boosted trees and a tokenizer take part, which SQL cannot say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table of documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_out(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
