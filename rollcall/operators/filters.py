"""Row filters shared by the analytic queries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where_equal(df: DataFrame, **wanted: Any) -> DataFrame:
    """Keep rows matching every value given; a value of None asks for nothing.

    Values become literals of the plan, never query text.
    """
    for column, value in wanted.items():
        if value is not None:
            df = df.where(F.col(column) == F.lit(value))
    return df


def where_in(
    df: DataFrame, column: str | Column, values: Iterable, when_empty: str = "none"
) -> DataFrame:
    """Keep rows whose column is in the list. An empty list keeps ``'none'`` or ``'all'``."""
    if when_empty not in ("none", "all"):
        raise ValueError("when_empty is 'none' or 'all'")
    values = list(values)
    if not values:
        return df if when_empty == "all" else df.where(F.lit(False))
    column = F.col(column) if isinstance(column, str) else column
    return df.where(column.isin(values))


def split_rows(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows meeting the condition, and all others, those where it is NULL included."""
    met = F.coalesce(condition, F.lit(False))
    return df.where(met), df.where(~met)


def opened_since(df: DataFrame, day: dt.date | str, column: str = "opened") -> DataFrame:
    return df.where(F.col(column) >= F.lit(day).cast("date"))


def closed_spans(reg: DataFrame, closed: Any) -> DataFrame:
    """Closed entities with a usable life span, and its length in ``days``.

    Spans that end before they begin, or lack an end, are left out.
    """
    return reg.where(
        (F.col("status") == F.lit(closed)) & (F.col("status_date") >= F.col("opened"))
    ).withColumn("days", F.datediff("status_date", "opened"))
