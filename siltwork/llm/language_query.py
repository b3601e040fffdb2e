"""Query 8: the language of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltwork.llm import language
from siltwork.llm.registry import query, table


@query()
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predicted(docs, language.fitted(docs))
