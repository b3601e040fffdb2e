"""Query 3: all documents packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltwork.llm import packing
from siltwork.llm.registry import query, table


@query()
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))
