"""Query 1: neighbours of every twentieth vector among all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.llm import neighbours
from siltwork.llm.registry import query, table


@query()
def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    queries = rows.where(F.pmod("vec_id", F.lit(20)) == 0)
    return neighbours.nearest(rows, queries, k=20)
