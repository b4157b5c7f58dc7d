"""Filter options, the strategic view with its indicators, and the capital ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.aggregates import count_by
from rollcall.operators.joins import attach_name, keep_named
from rollcall.operators.topk import first_by_key, largest_rows, top_groups

# Fixed value: size of the published sample.
SAMPLE_ROWS = 30_000
# Part of the entities with capital that the slice for rankings holds.
SLICE_SHARE = 0.01


def filter_options(codes: DataFrame) -> DataFrame:
    """Sorted distinct descriptions of a code table."""
    return codes.select("descricao").distinct().orderBy(F.col("descricao").asc_nulls_last())


def selection(
    reg: DataFrame,
    sec: DataFrame,
    mun: DataFrame,
    sector: str | None = None,
    city: str | None = None,
) -> DataFrame:
    """Entities with positive capital, of one sector and city if given."""
    rows = reg.where(F.col("capital") > 0)
    rows = keep_named(rows, sec, "sector_code", sector)
    return keep_named(rows, mun, "muni_code", city)


def sample(rows: DataFrame, n: int, repeatable: bool = True) -> DataFrame:
    """``n`` rows: those with the smallest identifiers, the same every time.

    When any rows will do, ``repeatable=False`` stops reading as soon as there are enough.
    """
    return first_by_key(rows, "entity_id", n) if repeatable else rows.limit(n)


def named(rows: DataFrame, sec: DataFrame, mun: DataFrame) -> DataFrame:
    """Published columns with sector and city names."""
    rows = attach_name(rows, sec, "sector_code", "setor")
    rows = attach_name(rows, mun, "muni_code", "cidade")
    return rows.select(
        F.col("name").alias("razao_social"),
        F.col("capital").alias("capital_social"),
        F.col("opened").alias("data_abertura"),
        "setor",
        "cidade",
    )


def strategic(
    reg: DataFrame,
    sec: DataFrame,
    mun: DataFrame,
    sector: str | None = None,
    city: str | None = None,
    limit: int | None = None,
    repeatable: bool = True,
) -> DataFrame:
    """Entities with names: all of them, or a sample of ``limit`` rows if one is asked for."""
    rows = selection(reg, sec, mun, sector, city)
    return named(rows if limit is None else sample(rows, limit, repeatable), sec, mun)


def indicators(rows: DataFrame) -> DataFrame:
    """Number of entities, total and mean capital of a selection or of its sample."""
    total = F.sum("capital")
    return rows.agg(
        F.count(F.lit(1)).alias("empresas"),
        total.alias("capital_total"),
        (total.cast("double") / F.nullif(F.count("capital"), F.lit(0))).alias("capital_medio"),
    )


def openings_by_year(rows: DataFrame) -> DataFrame:
    known = rows.where(F.col("opened").isNotNull())
    return count_by(known, F.year("opened").alias("ano"), name="qtd")


def capital_by_city(rows: DataFrame, mun: DataFrame, n: int = 10) -> DataFrame:
    """Cities with the most capital; entities without a named city are left out."""
    by_code = rows.groupBy("muni_code").agg(F.sum("capital").alias("capital"))
    cities = attach_name(by_code, mun, "muni_code", "cidade")
    return top_groups(cities, "cidade", F.sum("capital"), n, "capital_social")


def capital_slice(reg: DataFrame, share: float = SLICE_SHARE) -> DataFrame:
    """All entities from some capital on, about ``share`` of those with capital, ranges of it in files of their own.

    Whatever the floor, the slice is complete above it: a ranking that finds enough rows in it needs no others.
    The floor comes from a sketch of fixed size; the few rows of the slice are all that is shuffled.
    """
    rows = reg.where(F.col("capital") > 0)
    floor = rows.agg(F.percentile_approx("capital", 1 - share)).scalar()
    order = F.col("capital").desc(), F.col("entity_id")
    return rows.where(F.col("capital") >= floor).repartitionByRange(*order).sortWithinPartitions(*order)


def rank_capital(
    reg: DataFrame,
    sec: DataFrame,
    mun: DataFrame,
    n: int = 25,
    sector: str | None = None,
    city: str | None = None,
    top: DataFrame | None = None,
) -> DataFrame:
    """Entities with the most capital. Only the n rows found are joined to names.

    ``top`` is :func:`capital_slice` as published with ``reg``. It is asked first, for ``n`` rows of the
    selection; where it has fewer, all of ``reg`` is ranked.
    """
    order = (F.col("capital").desc(), F.col("entity_id"))
    rows = selection(reg, sec, mun, sector, city)
    if top is not None:
        few = selection(top, sec, mun, sector, city)
        rows = few if few.limit(n).count() == n else rows
    found = largest_rows(rows, n, "capital", "entity_id", nulls=False)
    rows = attach_name(found, sec, "sector_code", "setor")
    rows = attach_name(rows, mun, "muni_code", "cidade").orderBy(*order)
    return rows.select(
        F.col("name").alias("razao_social"),
        F.col("capital").alias("capital_social"),
        F.col("opened").alias("data_abertura"),
        "setor",
        "cidade",
    )
