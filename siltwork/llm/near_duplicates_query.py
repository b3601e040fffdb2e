"""Query 4: groups of near duplicates among all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.llm import near_duplicates
from siltwork.llm.registry import query, table


@query()
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates.grouped(table(spark, sf_dir, "documents"), size=2, threshold=0.8)
    return rows.select(
        "doc_id",
        F.col("__n").alias("n_shingles"),
        F.col("__component").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("__component")).alias("kept"),
    )
