"""Customer cleansing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.functions.codes import GENDER_CODES, map_codes
from siltwork.operators.keys import latest_per_key


def cleanse_customers(
    df: DataFrame, tie_breakers: Sequence[str] | None = None
) -> DataFrame:
    """The newest row per customer with trimmed names and a spelled-out gender."""
    newest = latest_per_key(df, "cst_id", "cst_create_date", tie_breakers)
    return newest.select(
        "cst_id",
        "cst_key",
        F.trim("cst_firstname").alias("cst_firstname"),
        F.trim("cst_lastname").alias("cst_lastname"),
        map_codes("cst_gndr", GENDER_CODES).alias("cst_gndr"),
        "cst_create_date",
    )
