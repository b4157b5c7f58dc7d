"""Joins of facts, or of their aggregates, to code tables.

No join here forces a broadcast. Code tables are read from files, so the planner knows their size:
it broadcasts one under spark.sql.autoBroadcastJoinThreshold and otherwise shuffles both sides, with
adaptive skew splitting for hot codes. Callers aggregate by code first wherever the result allows
it, so that the rows reaching a join are few and no code is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_name(
    df: DataFrame, codes: DataFrame, code: str, name: str, how: str = "left"
) -> DataFrame:
    """Add the description of ``code`` from a (codigo, descricao) table as column ``name``."""
    dim = codes.select(F.col("codigo").alias(f"__{name}"), F.col("descricao").alias(name))
    return df.join(dim, F.col(code) == F.col(f"__{name}"), how).drop(f"__{name}")


def keep_named(df: DataFrame, codes: DataFrame, code: str, wanted: str | None) -> DataFrame:
    """Keep rows whose code carries the wanted description; None keeps all.

    The code table is cut to the wanted codes before it meets the facts.
    """
    if wanted is None:
        return df
    dim = codes.where(F.col("descricao") == F.lit(wanted)).select(
        F.col("codigo").alias("__wanted")
    )
    return df.join(dim, F.col(code) == F.col("__wanted"), "left_semi")


def unmatched(df: DataFrame, codes: DataFrame, code: str) -> DataFrame:
    """Rows whose code the table lacks, rows without a code included."""
    dim = codes.select(F.col("codigo").alias("__known"))
    return df.join(dim, F.col(code) == F.col("__known"), "left_anti")


def keep_groups(df: DataFrame, groups: DataFrame, *keys: str) -> DataFrame:
    """Keep rows of the listed groups."""
    return df.join(groups.select(*keys), list(keys), "left_semi")
