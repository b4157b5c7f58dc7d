"""Window patterns on grouped rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.numbers import percent


def with_share(df: DataFrame, n: str, name: str = "pct", decimals: int = 1) -> DataFrame:
    """Add each row's percentage of the total of column ``n``.

    The window spans all rows in one task, so ``df`` must be grouped by something with few values
    (status, decade), never by facts.
    """
    total = F.sum(n).over(Window.partitionBy())
    return df.withColumn(name, percent(F.col(n), total, decimals))


def top_row(df: DataFrame, group: str, by: str, key: str) -> DataFrame:
    """One row per group: its largest ``by``, the smallest numeric ``key`` among equals.

    A maximum over (by, -key) pairs, which combines on the map side and needs no sort.
    """
    best = F.max(F.struct(F.col(by), (-F.col(key)).alias("k")))
    return (
        df.groupBy(group)
        .agg(best.alias("__best"))
        .select(group, F.col(f"__best.{by}").alias(by), (-F.col("__best.k")).alias(key))
    )
