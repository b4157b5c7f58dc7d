"""Capital statistics of the executive report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.labels import BAND_EDGES, BAND_NAMES, band
from rollcall.operators.joins import attach_name
from rollcall.operators.topk import top_rows


def capital_stats(reg: DataFrame) -> DataFrame:
    """Count, sum, largest and mean of positive capital."""
    total, n = F.sum("capital"), F.count(F.lit(1))
    return reg.where(F.col("capital") > 0).agg(
        n.alias("total"),
        total.alias("soma"),
        F.max("capital").alias("maximo"),
        (total.cast("double") / F.nullif(n, F.lit(0))).alias("media"),
    )


def capital_by_nature(reg: DataFrame, nat: DataFrame, n: int = 10) -> DataFrame:
    """Legal natures with the highest mean positive capital; unknown natures are left out."""
    by_code = (
        reg.where(F.col("capital") > 0)
        .groupBy("legal_nature")
        .agg(F.sum("capital").alias("total"), F.count(F.lit(1)).alias("n"))
    )
    named = attach_name(by_code, nat, "legal_nature", "natureza", how="inner")
    mean = F.sum("total").cast("double") / F.sum("n")
    grouped = (
        named.where(F.col("natureza").isNotNull())
        .groupBy("natureza")
        .agg(mean.alias("capital_medio"))
    )
    return top_rows(grouped, n, F.col("capital_medio").desc(), "natureza")


def capital_bands(
    reg: DataFrame,
    edges: Sequence[float] = BAND_EDGES,
    names: Sequence[str] = BAND_NAMES,
) -> DataFrame:
    """Entities per capital band, in band order; an empty band counts 0."""
    mine = band(F.col("capital"), edges, names)
    counts = reg.agg(*[F.count_if(mine == F.lit(b)).alias(f"b{i}") for i, b in enumerate(names)])
    rows = [
        F.struct(F.lit(b).alias("faixa_capital"), F.col(f"b{i}").alias("empresas"))
        for i, b in enumerate(names)
    ]
    return counts.select(F.inline(F.array(*rows)))
