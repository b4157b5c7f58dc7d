"""Side-by-side comparison of any regions.

A region is a state column (``uf``), a two-digit prefix of the municipality code (``prefix``), or a
municipality (``muni``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions.labels import (
    code_or_name,
    counted,
    division_name,
    region_label,
    state_name,
)
from rollcall.functions.numbers import money_mean, percent
from rollcall.functions.text import code_prefix, has_prefix
from rollcall.operators.aggregates import count_by, pivot_sum
from rollcall.operators.filters import opened_since
from rollcall.operators.joins import attach_name
from rollcall.operators.topk import top_rows
from rollcall.operators.windows import top_row

# Sectors shown, first year, choices offered.
TOP_SECTORS = 8
SINCE_YEAR = 2000
TOP_MUNIS = 100

_KEYS = {"uf": "uf", "prefix": "cod_uf", "muni": "cod_municipio"}


def _region(by: str, muni: str = "muni_code") -> Column:
    if by == "uf":
        return F.col("uf")
    if by == "prefix":
        return code_prefix(F.col(muni))
    if by == "muni":
        return F.col(muni)
    raise ValueError("by is 'uf', 'prefix' or 'muni'")


def _chosen(df: DataFrame, by: str, values: Sequence, muni: str = "muni_code") -> DataFrame:
    """Rows of the chosen regions, any number of them; the filter is one that reaches the scan."""
    values = list(dict.fromkeys(values))
    if by == "prefix":
        return df.where(has_prefix(F.col(muni), values))
    return df.where(_region(by, muni).isin(values))


def _summed(df: DataFrame, by: str, *keys: Column, **sums: Column) -> DataFrame:
    """Sums per region: facts are grouped by a stored column, a prefix is cut from the few codes."""
    stored = "uf" if by == "uf" else "muni_code"
    grouped = df.groupBy(stored, *keys).agg(*[c.alias(n) for n, c in sums.items()])
    grouped = grouped.withColumn(_KEYS[by], _region(by))
    if by != "prefix":
        return grouped
    names = [c for c in grouped.columns if c not in {stored, _KEYS[by], *sums}]
    return grouped.groupBy(_KEYS[by], *names).agg(*[F.sum(n).alias(n) for n in sums])


def _labelled(df: DataFrame, by: str, mun: DataFrame | None) -> DataFrame:
    """Add what users call the region."""
    if by == "prefix":
        return df.withColumn("sigla_uf", state_name(F.col("cod_uf")))
    if by == "muni":
        if mun is None:
            raise ValueError("municipality names are needed")
        named = attach_name(df, mun, "cod_municipio", "descricao")
        name = code_or_name(F.col("descricao"), F.col("cod_municipio"))
        return named.withColumn("nome_municipio", name).drop("descricao")
    return df


def compare_kpis(
    reg: DataFrame, by: str, values: Sequence, mun: DataFrame | None = None
) -> DataFrame:
    """Entities and mean positive capital of each chosen region."""
    key, positive = _KEYS[by], F.col("capital") > 0
    sums = _summed(
        _chosen(reg, by, values), by, total_empresas=F.count(F.lit(1)),
        __capital=F.sum(F.when(positive, F.col("capital"))), __positive=F.count_if(positive),
    )
    kpis = sums.select(
        key,
        "total_empresas",
        money_mean(F.col("__capital"), F.col("__positive")).alias("capital_medio"),
    )
    return _labelled(kpis, by, mun)


def compare_sectors(
    reg: DataFrame,
    by: str,
    values: Sequence,
    top_n: int = TOP_SECTORS,
    mun: DataFrame | None = None,
    pad: int | None = None,
) -> DataFrame:
    """Percentage of each chosen region's entities in the selection's largest sector divisions.

    The percentage is of all divisions, so those shown do not add up to 100. Facts are read once, by
    stored codes; each division gathers its regions, at most one row for each, and a top-n of the
    divisions is opened again. So no task holds all regions times all divisions.
    """
    key = _KEYS[by]
    rows = _chosen(reg.where(F.col("sector_code").isNotNull()), by, values)
    codes = _summed(rows, by, F.col("sector_code"), n=F.count(F.lit(1)))
    division = code_prefix(F.col("sector_code"), pad=pad).alias("divisao")
    base = codes.groupBy(key, division).agg(F.sum("n").alias("n"))
    base = base.withColumn("__region", F.sum("n").over(Window.partitionBy(key)))
    divisions = base.groupBy("divisao").agg(
        F.sum("n").alias("__division"), F.collect_list(F.struct(key, "n", "__region")).alias("__rows")
    )
    top = top_rows(divisions, top_n, F.col("__division").desc(), "divisao")
    shares = top.select("divisao", F.inline("__rows")).select(
        key, "divisao", percent(F.col("n"), F.col("__region"), 2).alias("pct")
    )
    return (
        _labelled(shares, by, mun)
        .withColumn("setor", division_name(F.col("divisao")))
        .orderBy(key, F.col("pct").desc(), "divisao")
    )


def sector_heatmap(shares: DataFrame, column: str, regions: Sequence) -> DataFrame:
    """Sectors by regions, percentages, 0 where a region lacks the sector."""
    return pivot_sum(shares, "setor", column, "pct", regions)


def compare_growth(
    mart: DataFrame,
    by: str,
    values: Sequence,
    since: int = SINCE_YEAR,
    mun: DataFrame | None = None,
) -> DataFrame:
    """Openings per chosen region and year, from the growth mart.

    The mart knows municipalities only; for states use :func:`growth_by_state`.
    """
    if by == "uf":
        raise ValueError("the growth mart has no state column")
    rows = _chosen(mart.where(F.col("ano") >= since), by, values, "cod_municipio")
    rows = rows.withColumn(_KEYS[by], _region(by, "cod_municipio"))
    if by == "muni":
        rows = rows.select("cod_municipio", "ano", F.col("total").alias("aberturas"))
        return _labelled(rows, by, mun).orderBy("cod_municipio", "ano")
    summed = rows.groupBy("cod_uf", "ano").agg(F.sum("total").alias("aberturas"))
    return _labelled(summed, by, mun).orderBy("cod_uf", "ano")


def growth_by_state(reg: DataFrame, values: Sequence, since: int = SINCE_YEAR) -> DataFrame:
    """Openings per chosen state and year, from the gold table."""
    rows = _chosen(opened_since(reg, dt.date(since, 1, 1)), "uf", values)
    return count_by(rows, "uf", F.year("opened").alias("ano"), name="aberturas").orderBy("uf", "ano")


def _counts_by_muni(reg: DataFrame, by: str) -> DataFrame:
    """Entities per region and municipality, counted by stored columns; a prefix is cut from the
    few codes counted, not from every row."""
    stored = ["uf", "muni_code"] if by == "uf" else ["muni_code"]
    rows = reg.where(F.col("muni_code").isNotNull() & _region(by).isNotNull())
    counts = count_by(rows, *stored).withColumn("muni_code", F.col("muni_code").cast("bigint"))
    return counts if by == "uf" else counts.withColumn(_KEYS[by], _region(by))


def regions_available(reg: DataFrame, mun: DataFrame, by: str = "prefix") -> DataFrame:
    """Every region with its entities and the name of its most populous municipality.

    Facts are counted once by region and municipality; the largest municipality and the region
    total both come from those counts.
    """
    key = _KEYS[by]
    best = F.max(F.struct("n", (-F.col("muni_code")).alias("k")))
    summed = _counts_by_muni(reg, by).groupBy(key).agg(
        F.sum("n").alias("total_empresas"), best.alias("__best")
    )
    top = summed.select(key, "total_empresas", (-F.col("__best.k")).alias("__muni"))
    named = attach_name(top, mun, "__muni", "municipio_mais_comum")
    label = region_label(F.col(key), F.col("municipio_mais_comum"), F.col("total_empresas"))
    return named.select(
        key, "total_empresas", "municipio_mais_comum", label.alias("label")
    ).orderBy(F.col("total_empresas").desc(), key)


def munis_top(reg: DataFrame, mun: DataFrame, n: int = TOP_MUNIS) -> DataFrame:
    """Municipalities with the most entities."""
    counts = count_by(reg, F.col("muni_code").alias("cod_municipio"), name="total_empresas")
    order = (F.col("total_empresas").desc(), F.col("cod_municipio").asc_nulls_last())
    top = attach_name(top_rows(counts, n, *order), mun, "cod_municipio", "descricao")
    name = code_or_name(F.col("descricao"), F.col("cod_municipio"))
    label = counted(F.col("nome_municipio"), F.col("total_empresas"))
    return (
        top.select("cod_municipio", name.alias("nome_municipio"), "total_empresas")
        .withColumn("label", label)
        .orderBy(*order)
    )


def capital_bar(kpis: DataFrame, region: str) -> DataFrame:
    """Regions by mean capital, ascending; regions without one are left out."""
    return (
        kpis.where(F.col("capital_medio").isNotNull())
        .select(region, "capital_medio")
        .orderBy("capital_medio", region)
    )


def largest_by_region(reg: DataFrame, by: str = "uf") -> DataFrame:
    """The municipality with the most entities in each region."""
    counts = _counts_by_muni(reg, by).withColumnsRenamed({"muni_code": "cod_municipio", "n": "qtd"})
    return top_row(counts, _KEYS[by], "qtd", "cod_municipio")
