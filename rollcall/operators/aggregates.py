"""Grouping patterns that stay small under skew.

Each works on counts by value before it works on groups: the first step combines rows on the map
side, so a group holding a large part of all rows reaches the second step as few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str | Column, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def spread_of_days(
    counts: DataFrame, *keys: str, probs: dict[str, float], freq: str = "n", days: str = "days"
) -> DataFrame:
    """Count, sum, largest value and exact interpolated percentiles from (keys, days, n) rows.

    Days are whole numbers, so even a huge group has no more rows here than there are distinct
    day counts, and the percentile's own state is bounded the same way.
    """
    freq_col = F.col(freq)
    points = F.array(*[F.lit(p) for p in probs.values()])
    summed = counts.groupBy(*keys).agg(
        F.sum(freq_col).alias("total"),
        F.sum(F.col(days).cast("bigint") * freq_col).alias("sum_days"),
        F.max(days).alias("max_days"),
        F.percentile(F.col(days), points, freq_col).alias("__points"),
    )
    shown = [F.col("__points")[i].alias(name) for i, name in enumerate(probs)]
    return summed.select(*keys, "total", "sum_days", "max_days", *shown)


def weighted_mean(value: str | Column, weight: str | Column) -> Column:
    """Mean of group figures weighted by group size.

    Of group means this is the overall mean; of group medians it is only a summary, not a median.
    """
    value = F.col(value) if isinstance(value, str) else value
    weight = F.col(weight) if isinstance(weight, str) else weight
    return F.sum(value * weight) / F.sum(weight)


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys found more than once, with their number of rows."""
    return count_by(df, *keys).where(F.col("n") > 1)


def pivot_sum(
    df: DataFrame, row: str, column: str, value: str, columns: Sequence
) -> DataFrame:
    """Table of sums, 0 where there is none, rows with the largest total first.

    The columns are given, so no extra pass looks for them.
    """
    names = [str(c) for c in columns]
    wide = df.groupBy(row).pivot(column, list(columns)).agg(F.sum(value))
    wide = wide.select(row, *[F.coalesce(F.col(f"`{n}`"), F.lit(0.0)).alias(n) for n in names])
    total = sum((F.col(f"`{n}`") for n in names), F.lit(0.0))
    return wide.orderBy(total.desc(), F.col(row))
