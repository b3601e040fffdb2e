"""Declared constraints that Parquet tables do not enforce: NOT NULL and length."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VIOLATIONS = "violations"


def null_rules(cols: Sequence[str]) -> dict[str, Column]:
    return {f"{c} is null": F.col(c).isNull() for c in cols}


def length_rules(limits: Mapping[str, int]) -> dict[str, Column]:
    return {f"{c} longer than {n}": F.length(c) > n for c, n in limits.items()}


def declared_rules(schema: T.StructType, columns: Sequence[str]) -> dict[str, Column]:
    """Rules for ``columns`` as ``schema`` declares them."""
    declared = [schema[c] for c in columns]
    return null_rules([f.name for f in declared if not f.nullable]) | length_rules(
        {f.name: f.dataType.length for f in declared if isinstance(f.dataType, T.VarcharType)}
    )


def fit_rules(df: DataFrame, schema: T.StructType) -> dict[str, Column]:
    """A value that ``schema``'s type cannot hold."""
    return {
        f"{f.name} does not fit {f.dataType.simpleString()}": F.col(f.name).isNotNull()
        & F.col(f.name).try_cast(f.dataType).isNull()
        for f in schema
        if not isinstance(f.dataType, (T.StringType, T.VarcharType))
        and df.schema[f.name].dataType != f.dataType
    }


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in ``schema``'s column order and types, with the rules each row breaks."""
    rules = declared_rules(schema, schema.names) | fit_rules(df, schema)
    typed = [
        F.col(f.name)
        if isinstance(f.dataType, T.VarcharType)
        else F.col(f.name).try_cast(f.dataType).alias(f.name)
        for f in schema
    ]
    return tag_violations(df, rules).select(*typed, VIOLATIONS)


def tag_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``df`` with the broken rules in one text column, NULL when all are kept."""
    broken = F.concat_ws("; ", *[F.when(rule, F.lit(name)) for name, rule in rules.items()])
    return df.withColumn(VIOLATIONS, F.nullif(broken, F.lit("")))


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(VIOLATIONS).isNull()).drop(VIOLATIONS)


def quarantined(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(VIOLATIONS).isNotNull())
