"""Changes of gold as signed rows, and the sums behind the marts brought up to date from these alone.

A signed row is a row of gold with 1 or -1: it came, or it went. A row that changed is both. Sums and counts of
signed rows are what the sums of all rows grow by, so marts that are made of sums, exact percentiles
included (they are taken from counts by days), need no reading of rows that stayed as they were.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.plans import marts

SIGN = "__sign"
# Columns of gold that the marts are made of: a change elsewhere is none to them.
MART_COLUMNS = ("capital", "opened", "sector_code", "muni_code", "uf", "status", "status_date")


def signed(df: DataFrame, sign: int) -> DataFrame:
    return df.withColumn(SIGN, F.lit(sign))


def difference(
    old: DataFrame, new: DataFrame, key: str = "entity_id", columns: Iterable[str] = MART_COLUMNS
) -> DataFrame:
    """Signed rows (``columns`` and the sign) that make ``new`` of ``old``.

    Keys must be unique in each, as the gates require. Rows are compared column by column, missing values
    equal to each other. Tables in the same buckets by ``key`` are compared without an exchange.
    """
    columns = list(columns)
    was = old.select(key, F.struct(*columns).alias("__was"))
    now = new.select(key, F.struct(*columns).alias("__now"))
    pairs = was.join(now, key, "full").where(~F.col("__was").eqNullSafe(F.col("__now")))
    moves = F.array(*[
        F.struct(F.col(row).alias("row"), F.lit(sign).alias(SIGN))
        for row, sign in (("__was", -1), ("__now", 1))
    ])
    rows = pairs.select(F.inline(F.filter(moves, lambda m: m["row"].isNotNull())))
    return rows.select("row.*", SIGN)


def _touched(rows: DataFrame, gone: DataFrame | None, key: str) -> DataFrame:
    """Keys that changed or are gone, repeated ones included: they only say which rows stay."""
    keys = rows.select(key)
    return keys if gone is None else keys.unionByName(gone.select(key))


def after_changes(
    gold: DataFrame, rows: DataFrame, gone: DataFrame | None = None, key: str = "entity_id",
    buckets: int | None = None,
) -> DataFrame:
    """Gold with ``rows`` in place of those of the same key or besides them, and without the keys ``gone``.

    A key in both is changed, not gone. With ``buckets`` the new rows are laid out as gold in so many is, so
    the old ones are copied where they lie.
    """
    rows = rows.select(*gold.columns)
    stay = gold.join(_touched(rows, gone, key), key, "left_anti").select(*gold.columns)
    return stay.unionByName(rows if buckets is None else rows.repartition(buckets, key))


def rows_before(
    gold: DataFrame, rows: DataFrame, gone: DataFrame | None = None, key: str = "entity_id"
) -> DataFrame:
    """What the marts are made of in those rows of gold that changes replace or take away."""
    return gold.join(_touched(rows, gone, key), key, "left_semi").select(*MART_COLUMNS)


def changes_of(
    gold: DataFrame, rows: DataFrame, gone: DataFrame | None = None, key: str = "entity_id"
) -> DataFrame:
    """Signed rows of the same changes. Rows that stay the same come with both signs, which add up to nothing."""
    return signed_changes(rows_before(gold, rows, gone, key), rows)


def signed_changes(went: DataFrame, came: DataFrame) -> DataFrame:
    return signed(went, -1).unionByName(signed(came.select(*MART_COLUMNS), 1))


# --- sums ---------------------------------------------------------------------------------------


def merged(
    stored: DataFrame, grown: DataFrame, keys: Iterable[str], amounts: Mapping[str, str]
) -> DataFrame:
    """Stored sums plus the sums of signed rows, groups without rows left out.

    ``amounts`` names the count behind each sum: where it is 0 the sum is missing, as in sums made anew.
    """
    keys, kinds = list(keys), dict(stored.dtypes)
    both = stored.unionByName(grown.select(*stored.columns))
    measures = [c for c in stored.columns if c not in keys]
    sums = both.groupBy(*keys).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in measures])

    def shown(name: str) -> Column:
        if name not in amounts:
            return F.col(name)
        return F.when(F.col(amounts[name]) != 0, F.col(name)).alias(name)

    return sums.where(F.col("n") != 0).select(*[shown(c) for c in stored.columns])


def merged_sums(
    places: DataFrame,
    sectors: DataFrame,
    changes: DataFrame,
    *,
    closed: Any = marts.CLOSED,
    active: Any = marts.ACTIVE,
    since: dt.date | str = marts.GROWTH_SINCE,
) -> tuple[DataFrame, DataFrame]:
    """Both groupings behind the marts after ``changes``, which must be written: they are read twice."""
    sign = F.col(SIGN)
    return (
        merged(places, marts.place_sums(changes, active, since, sign), marts.PLACE_KEYS, marts.PLACE_SUMS),
        merged(sectors, marts.sector_sums(changes, closed, sign), marts.SECTOR_KEYS, marts.SECTOR_SUMS),
    )


def fits(sums: DataFrame, rows: int) -> bool:
    """False when a count is negative or all of them do not add up to the rows of gold.

    Either says that the sums were made of another gold than the one that changed.
    """
    counts = [c for c, kind in sums.dtypes if kind == "bigint" and c in ("n", "positive", "active", "with_capital")]
    least = F.least(*[F.col(c) for c in counts]) if len(counts) > 1 else F.col(counts[0])
    total, low = sums.agg(F.coalesce(F.sum("n"), F.lit(0)), F.min(least)).first()
    return total == rows and (low is None or low >= 0)
