"""Query 9: personal data in all documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.llm import personal_data
from siltwork.llm.registry import query, table


@query()
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = personal_data.spans(docs)
    sure = F.filter("__spans", lambda c: c["sure"])

    def count(kind: int) -> Column:
        return F.size(F.filter(sure, lambda c: c["kind"] == kind)).cast("bigint")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(personal_data.KINDS)]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(personal_data.joined(sure), 256).alias("base_sha256"),
        personal_data.joined(F.col("__spans")).alias("spans"),
    )
