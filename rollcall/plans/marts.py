"""Pre-aggregated tables and the queries that read them.

Every mart groups by code first and names the few grouped rows afterwards, so facts are read once,
shuffled only as partial aggregates, and never joined.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.labels import code_or_name, sector_label
from rollcall.functions.dates import years
from rollcall.functions.numbers import money_mean, percent, round_ratio
from rollcall.functions.text import code_prefix
from rollcall.operators.aggregates import count_by, spread_of_days, weighted_mean
from rollcall.operators.filters import closed_spans, opened_since, where_in
from rollcall.operators.joins import attach_name, keep_groups
from rollcall.operators.topk import rows_of_top_groups, top_groups, top_rows
from rollcall.session import stage

# Status codes, thresholds and percentiles of the published reports.
ACTIVE = 2
CLOSED = 8
MIN_SECTOR_SIZE = 1000
GROWTH_SINCE = dt.date(1990, 1, 1)
SECTOR_POINTS = {"mediana": 0.50, "p05": 0.05, "q1": 0.25, "q3": 0.75, "p95": 0.95}


def mean_years(decimals: int, sum_days: str = "sum_days", total: str = "total") -> Column:
    """Mean of day counts in years of 365.25 days (1461 days per 4 years), rounded exactly."""
    return round_ratio(F.col(sum_days) * F.lit(4), F.col(total) * F.lit(1461), decimals)


# --- survival -----------------------------------------------------------------------------------


def survival_by_sector(
    reg: DataFrame, sec: DataFrame, *, closed: Any = CLOSED, min_n: int = MIN_SECTOR_SIZE
) -> DataFrame:
    """Years from opening to closing per sector name: count, mean and percentiles."""
    return _survival(count_by(closed_spans(reg, closed), "sector_code", "days"), sec, min_n)


def _survival(counts: DataFrame, sec: DataFrame, min_n: int) -> DataFrame:
    """The survival figures from (sector_code, days, n)."""
    named = attach_name(counts, sec, "sector_code", "descricao").select(
        sector_label(F.col("descricao"), F.col("sector_code")).alias("setor"), "days", "n"
    )
    spread = spread_of_days(named, "setor", probs=SECTOR_POINTS).where(F.col("total") >= min_n)
    points = [F.round(years(F.col(p)), 2).alias(p) for p in SECTOR_POINTS]
    return spread.select("setor", "total", mean_years(2).alias("media"), *points)


def longest_lived(mart: DataFrame, n: int = 20) -> DataFrame:
    """Sectors with the highest median survival."""
    return top_rows(mart, n, F.col("mediana").desc_nulls_last(), F.col("setor").asc_nulls_last())


def survival_overall(shown: DataFrame) -> DataFrame:
    """Closed entities, mean, and weighted mean of medians over the sectors shown."""
    return shown.agg(
        F.sum("total").alias("total_baixadas"),
        weighted_mean("media", "total").alias("media_geral"),
        weighted_mean("mediana", "total").alias("mediana_geral"),
    )


# --- openings by year and municipality ----------------------------------------------------------


def _by_year_and_muni(reg: DataFrame, *aggs: Column) -> DataFrame:
    known = reg.where(F.col("opened").isNotNull() & F.col("muni_code").isNotNull())
    return known.groupBy(F.year("opened").alias("ano"), "muni_code").agg(*aggs)


def _named_muni(df: DataFrame, mun: DataFrame, *rest: str | Column) -> DataFrame:
    return attach_name(df, mun, "muni_code", "descricao").select(
        "ano",
        F.col("muni_code").alias("cod_municipio"),
        code_or_name(F.col("descricao"), F.col("muni_code")).alias("nome_municipio"),
        *rest,
    )


def growth_by_muni(
    reg: DataFrame, mun: DataFrame, since: dt.date | str = GROWTH_SINCE
) -> DataFrame:
    """Openings per year and municipality."""
    counts = _by_year_and_muni(opened_since(reg, since), F.count(F.lit(1)).alias("total"))
    return _named_muni(counts, mun, "total")


def growth_series(mart: DataFrame, by_code: bool = False) -> DataFrame:
    first = "cod_municipio" if by_code else "nome_municipio"
    return mart.orderBy(F.col(first).asc_nulls_last(), "ano", "cod_municipio")


def growth_of_largest(mart: DataFrame, n: int = 5, by: str = "nome_municipio") -> DataFrame:
    """Series of the municipalities with the most openings.

    By name, as shown to users, municipalities of the same name count as one; ``by`` the code they
    stay apart.
    """
    return keep_groups(mart, top_groups(mart, by, F.sum("total"), n, "sum_total"), by)


def largest_munis(mart: DataFrame, n: int = 30, by: str = "nome_municipio") -> DataFrame:
    return top_groups(mart, by, F.sum("total"), n, "total_empresas")


def bubbles(reg: DataFrame, mun: DataFrame) -> DataFrame:
    """Entities and mean capital per year and municipality, positive capital only."""
    sums = _by_year_and_muni(
        reg.where(F.col("capital") > 0),
        F.count(F.lit(1)).alias("total_empresas"),
        F.sum("capital").alias("__capital"),
    )
    mean = F.col("__capital").cast("double") / F.col("total_empresas")
    return _named_muni(sums, mun, "total_empresas", mean.alias("capital_medio"))


def bubbles_top_years(mart: DataFrame, n: int = 10) -> DataFrame:
    """Mart rows of the years with the most entities; a year has a row per municipality at most."""
    return rows_of_top_groups(mart, "ano", F.sum("total_empresas"), n).orderBy(
        "ano", F.col("nome_municipio").asc_nulls_last(), "cod_municipio"
    )


def first_names(mart: DataFrame, n: int | None = 20) -> DataFrame:
    """Sorted distinct municipality names: all of them, or the default selection."""
    names = mart.select("nome_municipio").where(F.col("nome_municipio").isNotNull()).distinct()
    return names.orderBy("nome_municipio") if n is None else top_rows(names, n, "nome_municipio")


def bubbles_selection(mart: DataFrame, names: list[str] | None = None, n: int = 20) -> DataFrame:
    """Rows of the chosen municipality names; the first ``n`` names when nothing is said.

    An empty choice shows all.
    """
    if names is None:
        return keep_groups(mart, first_names(mart, n), "nome_municipio")
    return where_in(mart, "nome_municipio", names, when_empty="all")


# --- sectors, states, regions -------------------------------------------------------------------


def division_totals(reg: DataFrame, pad: int | None = None) -> DataFrame:
    """Entities and capital per two-character sector division.

    ``pad=7`` restores the leading zeros that numeric sector codes have lost.
    """
    known = reg.where((F.col("capital") >= 0) & F.col("sector_code").isNotNull())
    codes = known.groupBy("sector_code").agg(F.count(F.lit(1)).alias("n"), F.sum("capital").alias("capital"))
    return _division_figures(codes, pad)


def _division_figures(codes: DataFrame, pad: int | None = None) -> DataFrame:
    """Divisions from (sector_code, n, capital): prefixes are cut from codes, not from facts."""
    return codes.groupBy(code_prefix(F.col("sector_code"), pad=pad).alias("divisao_cnae")).agg(
        F.sum("n").alias("total_empresas"), F.sum("capital").alias("capital_total")
    )


def treemap_ordered(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.col("total_empresas").desc(), "divisao_cnae")


def count_by_muni(reg: DataFrame) -> DataFrame:
    """Entities per municipality code, most first."""
    rows = reg.where(F.col("muni_code").isNotNull())
    counts = count_by(rows, F.col("muni_code").alias("cod_municipio"), name="total")
    return counts.orderBy(F.col("total").desc(), "cod_municipio")


def density_by_uf(reg: DataFrame) -> DataFrame:
    """Entities per state."""
    return count_by(reg.where(F.col("uf").isNotNull()), "uf", name="total")


def region_kpis(
    reg: DataFrame, region: Column | None = None, name: str = "cod_uf", active: Any = ACTIVE
) -> DataFrame:
    """Entities, mean positive capital and percentage active per region.

    Regions are two-digit prefixes of the municipality code unless another column is given.
    """
    stored = F.col("muni_code") if region is None else region
    positive = F.col("capital") > 0
    codes = reg.groupBy(stored.alias("__stored")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(positive).alias("positive"),
        F.sum(F.when(positive, F.col("capital"))).alias("positive_capital"),
        F.count_if(F.col("status") == F.lit(active)).alias("active"),
    )
    shown = code_prefix(F.col("__stored")) if region is None else F.col("__stored")
    return _region_figures(codes, shown, name)


def _region_figures(codes: DataFrame, region: Column, name: str) -> DataFrame:
    """Region figures from sums by a stored column; a prefix is cut from the few codes."""
    sums = codes.groupBy(region.alias(name)).agg(
        *[F.sum(c).alias(c) for c in ("n", "positive", "positive_capital", "active")]
    )
    return sums.select(
        name,
        F.col("n").alias("total_empresas"),
        money_mean(F.col("positive_capital"), F.col("positive")).alias("capital_medio"),
        percent(F.col("active"), F.col("n"), 1).alias("pct_ativas"),
    )


# --- all marts at once --------------------------------------------------------------------------


# Keys of the two groupings behind the marts, and what is counted and summed in them: each sum of capital
# with the count of rows in it.
PLACE_KEYS = ("ano", "muni_code", "uf", "recent")
PLACE_SUMS = {"positive_capital": "positive"}
SECTOR_KEYS = ("sector_code", "days")
SECTOR_SUMS = {"capital": "with_capital"}


def _count(sign: Column | None, where: Column | None = None) -> Column:
    """Number of rows, or the sum of their signs."""
    if sign is None:
        return F.count(F.lit(1)) if where is None else F.count_if(where)
    return F.coalesce(F.sum(sign if where is None else F.when(where, sign)), F.lit(0))


def _amount(sign: Column | None, where: Column) -> Column:
    capital = F.col("capital") if sign is None else F.col("capital") * sign
    return F.sum(F.when(where, capital))


def place_sums(
    reg: DataFrame, active: Any = ACTIVE, since: dt.date | str = GROWTH_SINCE, sign: Column | None = None
) -> DataFrame:
    """By opening year, municipality, state and whether the growth mart begins by then.

    With a ``sign`` rows count as often as it says: 1 for rows that came, -1 for rows that went.
    """
    opened, capital = F.col("opened"), F.col("capital")
    recent = F.coalesce(opened >= F.lit(since).cast("date"), F.lit(False))
    return reg.groupBy(F.year(opened).alias("ano"), "muni_code", "uf", recent.alias("recent")).agg(
        _count(sign).alias("n"),
        _count(sign, capital > 0).alias("positive"),
        _amount(sign, capital > 0).alias("positive_capital"),
        _count(sign, F.col("status") == F.lit(active)).alias("active"),
    )


def sector_sums(reg: DataFrame, closed: Any = CLOSED, sign: Column | None = None) -> DataFrame:
    """By sector code and, for closed entities, the days they lived; ``sign`` as in :func:`place_sums`."""
    capital = F.col("capital")
    lived = (F.col("status") == F.lit(closed)) & (F.col("status_date") >= F.col("opened"))
    days = F.when(lived, F.datediff("status_date", "opened"))
    return reg.groupBy("sector_code", days.alias("days")).agg(
        _count(sign).alias("n"),
        _count(sign, capital >= 0).alias("with_capital"),
        _amount(sign, capital >= 0).alias("capital"),
    )


class SharedSums:
    """Two groupings of the facts, each read and written once, from which every mart is summed.

    ``places`` and ``sectors`` are :func:`place_sums` and :func:`sector_sums`, or tables given that hold them.
    """

    def __init__(
        self,
        reg: DataFrame,
        closed: Any,
        active: Any,
        since: dt.date | str,
        stored: tuple[DataFrame, DataFrame] | None = None,
    ) -> None:
        self.reg, self.closed, self.active, self.since = reg, closed, active, since
        self.stored = stored

    @cached_property
    def places(self) -> DataFrame:
        if self.stored:
            return self.stored[0]
        return stage(place_sums(self.reg, self.active, self.since), "place-sums")

    @cached_property
    def sectors(self) -> DataFrame:
        if self.stored:
            return self.stored[1]
        return stage(sector_sums(self.reg, self.closed), "sector-sums")

    def growth(self, mun: DataFrame) -> DataFrame:
        rows = self.places.where(F.col("recent") & F.col("muni_code").isNotNull())
        return _named_muni(rows.groupBy("ano", "muni_code").agg(F.sum("n").alias("total")), mun, "total")

    def bubbles(self, mun: DataFrame) -> DataFrame:
        known = F.col("ano").isNotNull() & F.col("muni_code").isNotNull() & (F.col("positive") > 0)
        sums = self.places.where(known).groupBy("ano", "muni_code").agg(
            F.sum("positive").alias("total_empresas"), F.sum("positive_capital").alias("__capital")
        )
        mean = F.col("__capital").cast("double") / F.col("total_empresas")
        return _named_muni(sums, mun, "total_empresas", mean.alias("capital_medio"))

    def density(self) -> DataFrame:
        known = self.places.where(F.col("uf").isNotNull())
        return known.groupBy("uf").agg(F.sum("n").alias("total"))

    def regions(self, name: str = "cod_uf") -> DataFrame:
        codes = self.places.groupBy("muni_code").agg(
            *[F.sum(c).alias(c) for c in ("n", "positive", "positive_capital", "active")]
        )
        return _region_figures(codes, code_prefix(F.col("muni_code")), name)

    def divisions(self) -> DataFrame:
        codes = self.sectors.where(F.col("sector_code").isNotNull() & (F.col("with_capital") > 0))
        return _division_figures(codes.select(
            "sector_code", F.col("with_capital").alias("n"), "capital"
        ))

    def survival(self, sec: DataFrame, min_n: int) -> DataFrame:
        counts = self.sectors.where(F.col("days").isNotNull()).select("sector_code", "days", "n")
        return _survival(counts, sec, min_n)


# Unique key of each mart.
MART_KEYS = {
    "mart_survival_sector": ("setor",),
    "mart_growth_muni": ("ano", "cod_municipio"),
    "mart_bubbles": ("ano", "cod_municipio"),
    "mart_treemap": ("divisao_cnae",),
    "mart_density_uf": ("uf",),
    "mart_region_kpis": ("cod_uf",),
}


def mart_builders(
    reg: DataFrame,
    sec: DataFrame,
    mun: DataFrame,
    *,
    closed: Any = CLOSED,
    active: Any = ACTIVE,
    min_sector: int = MIN_SECTOR_SIZE,
    since: dt.date | str = GROWTH_SINCE,
    stored: tuple[DataFrame, DataFrame] | None = None,
) -> dict:
    """Every mart as a function without arguments, by name; together they read the facts twice.

    With ``stored`` sums (:func:`place_sums`, :func:`sector_sums`) they do not read the facts at all.
    """
    sums = SharedSums(reg, closed, active, since, stored)
    return {
        "mart_survival_sector": lambda: sums.survival(sec, min_sector),
        "mart_growth_muni": lambda: sums.growth(mun),
        "mart_bubbles": lambda: sums.bubbles(mun),
        "mart_treemap": lambda: sums.divisions(),
        "mart_density_uf": lambda: sums.density(),
        "mart_region_kpis": lambda: sums.regions(),
    }
