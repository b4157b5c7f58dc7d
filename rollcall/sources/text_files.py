"""Raw registry extracts as delimited text, and CSV export."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.numbers import to_long
from rollcall.functions.text import nul_count, strip_nul, strip_space
from rollcall.plans.gates import require_unique
from rollcall.schemas import CODES_RAW, ENTITY, ESTABLISHMENT
from rollcall.sources.split_text import read_split

log = logging.getLogger(__name__)

# Delimiter, quote and encoding of the published extracts. An unquoted empty field is
# NULL and a quoted one is empty text, so NULL is read from a text no extract contains.
RAW = {"sep": ";", "quote": '"', "escape": '"', "encoding": "ISO-8859-1"}
_NO_FIELD_TEXT = "\x01"
BOM = "\ufeff"


def read_raw(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    *,
    multiline: bool = True,
    mode: str = "FAILFAST",
    split: bool = False,
    shard: str | None = None,
) -> DataFrame:
    """Headerless extract files as text columns, all shards together.

    Quoted fields may hold line breaks. A file read with ``multiline`` is one task; with ``split`` it is
    one task per byte range, at the price of moving its lines once (:mod:`split_text`), and extracts known
    to have no breaks are split at none by turning ``multiline`` off. A record with too few or too many
    fields stops the load, unless another ``mode`` of the CSV reader is asked for. ``shard`` names a
    column for the file's name, with ``split``.
    """
    if split:
        options = {**RAW, "nullValue": _NO_FIELD_TEXT}
        return read_split(spark, paths, schema, options, mode=mode, shard=shard)
    if shard:
        raise ValueError("shard goes with split; else take _metadata.file_name")
    return (
        spark.read.schema(schema)
        .options(**RAW, nullValue=_NO_FIELD_TEXT, multiLine=multiline, mode=mode)
        .csv(paths)
    )


def read_entities(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    return nul_clean(read_raw(spark, paths, ENTITY, **options))


def read_establishments(spark: SparkSession, paths: str | Sequence[str], **options) -> DataFrame:
    return nul_clean(read_raw(spark, paths, ESTABLISHMENT, **options))


def write_raw(df: DataFrame, path: str, *partitions: str) -> None:
    """Write text columns in the layout of the extracts."""
    writer = df.write.options(**RAW, nullValue="", emptyValue='""')
    (writer.partitionBy(*partitions) if partitions else writer).csv(path)


def typed_codes(raw: DataFrame) -> DataFrame:
    """(codigo, descricao) with a numeric code, NULL where it is none, and trimmed text."""
    return raw.select(
        to_long(F.col("codigo")).alias("codigo"),
        strip_space(F.col("descricao")).alias("descricao"),
    )


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    return typed_codes(nul_clean(read_raw(spark, path, CODES_RAW)))


def read_code_tables(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Every code table found; one that is missing is logged and left out.

    A code listed twice would double every row that is joined to it, so it stops the load. Entries
    without a numeric code join to nothing and may repeat.
    """
    found = {}
    for name, path in paths.items():
        try:
            found[name] = read_codes(spark, path)
            require_unique(found[name].where(F.col("codigo").isNotNull()), "codigo")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("code table %s not found at %s", name, path)
    return found


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def nul_clean(df: DataFrame) -> DataFrame:
    """Drop 0x00 characters from every text column."""
    return df.withColumns({c: strip_nul(F.col(c)) for c in _text_columns(df)})


def nul_removed(df: DataFrame) -> DataFrame:
    """How many 0x00 characters :func:`nul_clean` drops."""
    per_row = reduce(lambda a, b: a + b, [nul_count(F.col(c)) for c in _text_columns(df)])
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0)).alias("removed"))


def shard_counts(df: DataFrame, shard: Column | None = None) -> DataFrame:
    """Rows per shard file and the running total in shard order.

    The window sees one row per shard.
    """
    shard = F.col("_metadata.file_name") if shard is None else shard
    counts = df.groupBy(shard.alias("shard")).agg(F.count(F.lit(1)).alias("rows"))
    running = F.sum("rows").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    )
    return counts.withColumn("running", running)


def export_csv(
    df: DataFrame,
    folder: str,
    stem: str,
    as_of: dt.date | None = None,
    *,
    bom: bool = True,
) -> str:
    """Write ``folder/stem_YYYYMMDD`` as UTF-8 with header and ``;``; returns the path.

    Every part file is a complete table for a spreadsheet, which wants a byte-order mark first.
    """
    path = f"{folder.rstrip('/')}/{stem}_{(as_of or dt.date.today()):%Y%m%d}"
    if bom:
        first = df.columns[0]
        df = df.withColumnRenamed(first, BOM + first)
    df.write.mode("overwrite").options(sep=";", header=True, emptyValue="").csv(path)
    return path
