"""Data-quality counters of the gold table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.dates import as_date
from rollcall.functions.labels import badge
from rollcall.functions.numbers import percent_or_zero

# First date accepted, and the counters in display order.
FIRST_ACCEPTED = dt.date(1800, 1, 1)
COUNTERS = ("capital_invalido", "data_invalida", "cnae_nao_mapeado")


def data_quality(
    reg: DataFrame, sec: DataFrame, as_of: dt.date | str | None = None
) -> DataFrame:
    """Rows, invalid capital, invalid opening date, unmapped sector, in one pass over the facts.

    Facts are counted by sector code, so the code table meets one row per code.
    """
    opened, capital = F.col("opened"), F.col("capital")
    bad_date = opened.isNull() | (opened < F.lit(FIRST_ACCEPTED)) | (opened > as_date(as_of))
    by_code = reg.groupBy("sector_code").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(capital.isNull() | (capital <= 0)).alias("bad_capital"),
        F.count_if(bad_date).alias("bad_date"),
    )
    known = sec.select(F.col("codigo").alias("known")).distinct()  # listed twice counts once
    joined = by_code.join(known, F.col("sector_code") == F.col("known"), "left")

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0))

    return joined.agg(
        total(F.col("n")).alias("total"),
        total(F.col("bad_capital")).alias("capital_invalido"),
        total(F.col("bad_date")).alias("data_invalida"),
        total(F.when(F.col("known").isNull(), F.col("n"))).alias("cnae_nao_mapeado"),
    )


def data_quality_badges(counters: DataFrame) -> DataFrame:
    """One row per counter: number, percentage of all rows, badge."""
    pairs = ", ".join(f"'{c}', {c}" for c in COUNTERS)
    rows = counters.selectExpr(
        "total", f"stack({len(COUNTERS)}, {pairs}) AS (indicador, registros)"
    )
    pct = percent_or_zero(F.col("registros"), F.col("total"))
    return rows.select("indicador", "registros", pct.alias("pct")).withColumn(
        "badge", badge(F.col("pct"))
    )
