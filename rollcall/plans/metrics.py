"""Published metrics: universe, ages, capital, status, survival, decades."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.dates import as_date, decade, years
from rollcall.functions.numbers import percent
from rollcall.functions.text import code_prefix, has_prefix
from rollcall.operators.aggregates import count_by, spread_of_days
from rollcall.operators.filters import closed_spans, opened_since
from rollcall.operators.windows import with_share
from rollcall.plans.marts import ACTIVE, CLOSED, mean_years

# Retail division, reported state and start of its series, reported percentiles.
RETAIL = "47"
STATE = "SP"
STATE_SINCE = dt.date(2015, 1, 1)
POINTS = {"mediana": 0.5, "p90": 0.9}


def universe(reg: DataFrame) -> DataFrame:
    return reg.agg(
        F.count(F.lit(1)).alias("empresas"),
        F.min("opened").alias("mais_antiga"),
        F.max("opened").alias("mais_recente"),
    )


def _rounded_points():
    return [F.round(years(F.col(p)), 1).alias(p) for p in POINTS]


def ages(
    reg: DataFrame, as_of: dt.date | str | None = None, status: Any | None = None
) -> DataFrame:
    """Mean, median, p90 and largest age in years, of all entities or those of one status."""
    rows = reg if status is None else reg.where(F.col("status") == F.lit(status))
    days = F.datediff(as_date(as_of), F.col("opened")).alias("days")
    counts = count_by(rows.where(F.col("opened").isNotNull()), days)
    spread = spread_of_days(counts, probs=POINTS)
    oldest = F.round(years(F.col("max_days")), 1).alias("maxima")
    return spread.select(mean_years(1).alias("media"), *_rounded_points(), oldest)


def age_active(
    reg: DataFrame, as_of: dt.date | str | None = None, active: Any = ACTIVE
) -> DataFrame:
    return ages(reg, as_of, active)


def capital_zero(reg: DataFrame) -> DataFrame:
    """Entities without capital, and their share; one pass for count and total."""
    counted = reg.agg(
        F.count_if(F.col("capital") == 0).alias("empresas"), F.count(F.lit(1)).alias("n")
    )
    return counted.select("empresas", percent(F.col("empresas"), F.col("n"), 1).alias("pct"))


def division_share(reg: DataFrame, division: str = RETAIL, pad: int | None = None) -> DataFrame:
    """Entities of one sector division, and their share of all.

    A division is a few ranges of whole-number codes; only ``pad`` needs them as text.
    """
    code = F.col("sector_code")
    mine = has_prefix(code, [division]) if pad is None else code_prefix(code, pad=pad) == F.lit(division)
    counted = reg.agg(F.count_if(mine).alias("empresas"), F.count(F.lit(1)).alias("n"))
    return counted.select("empresas", percent(F.col("empresas"), F.col("n"), 1).alias("pct"))


def status_share(reg: DataFrame) -> DataFrame:
    counts = count_by(reg, F.col("status").alias("situacao_cadastral"), name="empresas")
    return with_share(counts, "empresas").orderBy(
        F.col("empresas").desc(), F.col("situacao_cadastral").asc_nulls_last()
    )


def survival_global(reg: DataFrame, closed: Any = CLOSED) -> DataFrame:
    """Closed entities: count, mean, median and p90 of years lived."""
    spread = spread_of_days(count_by(closed_spans(reg, closed), "days"), probs=POINTS)
    total = F.coalesce(F.col("total"), F.lit(0)).alias("baixadas")
    return spread.select(total, mean_years(1).alias("media"), *_rounded_points())


def closed_discarded(reg: DataFrame, closed: Any = CLOSED) -> DataFrame:
    """Closed entities left out of survival: no closing date, or one before the opening."""
    return reg.where(F.col("status") == F.lit(closed)).agg(
        F.count_if(F.col("status_date").isNull()).alias("sem_data"),
        F.count_if(F.col("status_date") < F.col("opened")).alias("data_invertida"),
        F.count(F.lit(1)).alias("total_baixadas"),
    )


def state_openings_by_year(
    reg: DataFrame, uf: str = STATE, since: dt.date | str = STATE_SINCE
) -> DataFrame:
    rows = opened_since(reg.where(F.col("uf") == F.lit(uf)), since)
    return count_by(rows, F.year("opened").alias("ano"), name="empresas").orderBy("ano")


def decade_share(reg: DataFrame) -> DataFrame:
    counts = count_by(reg, decade(F.col("opened")).alias("decada"), name="empresas")
    return with_share(counts, "empresas").orderBy(F.col("decada").asc_nulls_last())
