"""Columns that are computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys over all shuffle partitions, however few bytes they have: for rows that take much work each."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with columns that are computed once: the optimizer writes a projected column into every expression that uses it, and expressions
    that are built on one another over several steps would grow by a factor at each. A generated row of one struct stands for itself."""
    kept = [c for c in df.columns if c not in columns]
    new = [f"_once_{k}" for k in columns]
    at = df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in zip(new, columns.values(), strict=True))))))
    return at.select(*(F.col(f"`{c}`") for c in kept), *(F.col(n).alias(k) for n, k in zip(new, columns, strict=True)))
