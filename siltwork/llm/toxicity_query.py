"""Query 2: toxicity of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltwork.llm import toxicity
from siltwork.llm.registry import query, table


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fitted(docs, table(spark, sf_dir, "labels")))
