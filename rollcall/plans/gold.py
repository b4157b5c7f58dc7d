"""Typing of the raw text layer and the join into one row per entity."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.dates import is_compact_date, parse_compact, plausible_opening
from rollcall.functions.numbers import decimal_comma, to_int, to_long, unreadable_amount
from rollcall.functions.text import blank_to_null, pad_id
from rollcall.operators.filters import split_rows
from rollcall.schemas import GOLD

# Fixed value: marker of a head office.
HEAD_OFFICE = "1"


def head_offices(establishments: DataFrame) -> DataFrame:
    return establishments.where(F.col("matriz_filial") == HEAD_OFFICE)


def split_quarantine(
    establishments: DataFrame, as_of: dt.date | str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Head offices with a plausible opening date, and those without one."""
    return split_rows(
        head_offices(establishments),
        plausible_opening(F.col("data_inicio_atividade"), as_of),
    )


def quarantine_count(
    establishments: DataFrame, as_of: dt.date | str | None = None
) -> DataFrame:
    _, set_aside = split_quarantine(establishments, as_of)
    return set_aside.agg(F.count(F.lit(1)).alias("quarantined"))


def quarantine_reasons(
    entities: DataFrame, establishments: DataFrame, as_of: dt.date | str | None = None
) -> DataFrame:
    """(reason, n) of everything a load sets aside or cannot read as it stands.

    Head offices are left out of gold for their opening date: missing, no date, or out of range. Amounts
    that cannot be read are NULL in gold, identifiers of more than eight characters stay whole.
    """
    opened = F.col("data_inicio_atividade")
    compact = is_compact_date(opened) & parse_compact(opened).isNotNull()
    why = (
        F.when(opened.isNull() | (opened == ""), "abertura_ausente")
        .when(F.coalesce(compact, F.lit(False)), "abertura_fora_do_intervalo")
        .otherwise("abertura_invalida")
    )
    _, aside = split_quarantine(establishments, as_of)
    of_dates = aside.groupBy(why.alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    counted = entities.agg(
        F.count_if(unreadable_amount(F.col("capital_social"))).alias("capital_ilegivel"),
        F.count_if(F.length("cnpj_basico") > 8).alias("identificador_longo"),
    )
    of_entities = counted.selectExpr(
        "stack(2, 'capital_ilegivel', capital_ilegivel, 'identificador_longo', identificador_longo)"
        " AS (reason, n)"
    )
    return of_dates.unionByName(of_entities.where("n > 0"))


def typed_entities(entities: DataFrame) -> DataFrame:
    return entities.select(
        pad_id(F.col("cnpj_basico")).alias("entity_id"),
        F.col("razao_social").alias("name"),
        to_long(blank_to_null(F.col("natureza_juridica"))).alias("legal_nature"),
        decimal_comma(F.col("capital_social")).alias("capital"),
    )


def typed_establishments(establishments: DataFrame) -> DataFrame:
    return establishments.select(
        pad_id(F.col("cnpj_basico")).alias("entity_id"),
        parse_compact(blank_to_null(F.col("data_inicio_atividade"), "0")).alias("opened"),
        to_long(blank_to_null(F.col("cnae_fiscal"))).alias("sector_code"),
        to_long(blank_to_null(F.col("municipio"))).alias("muni_code"),
        F.col("uf"),
        to_int(blank_to_null(F.col("situacao_cadastral"))).alias("status"),
        parse_compact(blank_to_null(F.col("data_situacao"), "0")).alias("status_date"),
    )


def build_gold(
    entities: DataFrame,
    establishments: DataFrame,
    as_of: dt.date | str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Entities joined to their head office, typed, quarantined rows left out.

    Both sides are cut to the needed columns and rows before the one shuffle on the identifier. With
    ``buckets`` that shuffle has so many partitions and rows lie as a table of so many buckets is written;
    adaptive execution then neither merges nor splits them, so an identifier with a large part of all rows
    is one long task. Gold whose identifiers are unique has none.
    """
    valid, _ = split_quarantine(establishments, as_of)
    sides = typed_entities(entities), typed_establishments(valid)
    if buckets is not None:
        sides = tuple(side.repartition(buckets, "entity_id") for side in sides)
    joined = sides[0].join(sides[1], "entity_id")
    return joined.select(*GOLD.fieldNames())
