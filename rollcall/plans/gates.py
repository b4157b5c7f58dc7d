"""Quality gates a gold table must pass before it is published."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.dates import FIRST_PLAUSIBLE, as_date, decade
from rollcall.functions.numbers import percent
from rollcall.operators.aggregates import count_by, repeated_keys

log = logging.getLogger(__name__)

# Names and thresholds of the gates.
MIN_ROWS = 40_000_000
MIN_RETENTION = 90.0
MAX_DECADE_SHARE = 60.0
GATES = ("volume", "retention", "unique", "complete", "domain", "distribution")


class GateFailure(RuntimeError):
    """One or more gates did not pass."""

    def __init__(self, failed: list[str]):
        super().__init__("load stopped, gates not passed: " + ", ".join(failed))
        self.failed = failed


def _figures(df: DataFrame, **figures: Column) -> DataFrame:
    """One aggregated row, turned into (figure, value) rows."""
    row = df.agg(*[c.cast("bigint").alias(n) for n, c in figures.items()])
    pairs = ", ".join(f"'{n}', {n}" for n in figures)
    return row.selectExpr(f"stack({len(figures)}, {pairs}) AS (figure, value)")


def gate_figures(
    gold: DataFrame, bronze_entities: DataFrame, as_of: dt.date | str | None = None
) -> DataFrame:
    """The counts behind the gates, as one row.

    Three passes in one job: gold by decade (a few dozen groups answer volume, completeness, domain
    and distribution together), gold by identifier, and the bronze row count.
    """
    bad = (F.col("opened") < F.lit(FIRST_PLAUSIBLE)) | (F.col("opened") > as_date(as_of))
    by_decade = gold.groupBy(decade(F.col("opened")).alias("decade")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad")
    )
    n = F.col("n")
    dates = _figures(
        by_decade,
        gold_rows=F.coalesce(F.sum(n), F.lit(0)),
        undated=F.coalesce(F.sum(F.when(F.col("decade").isNull(), n)), F.lit(0)),
        implausible=F.coalesce(F.sum("bad"), F.lit(0)),
        largest_decade=F.max(n),
    )
    by_id = count_by(gold, "entity_id")
    ids = _figures(
        by_id,
        duplicates=F.coalesce(F.sum(n) - F.count("entity_id"), F.lit(0)),
    )
    bronze = _figures(bronze_entities, bronze_rows=F.count(F.lit(1)))
    names = ("gold_rows", "undated", "implausible", "largest_decade", "duplicates", "bronze_rows")
    rows = dates.unionByName(ids).unionByName(bronze)
    return rows.agg(*[F.max(F.when(F.col("figure") == f, F.col("value"))).alias(f) for f in names])


def run_gates(
    gold: DataFrame,
    bronze_entities: DataFrame,
    *,
    min_rows: int = MIN_ROWS,
    min_retention: float = MIN_RETENTION,
    max_decade_share: float = MAX_DECADE_SHARE,
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """One row per gate: gate, value, passed. A gate without a value does not pass."""
    f = {c: F.col(c) for c in (
        "gold_rows", "undated", "implausible", "largest_decade", "duplicates", "bronze_rows",
    )}
    retention = percent(f["gold_rows"], f["bronze_rows"], 2)
    concentration = percent(f["largest_decade"], f["gold_rows"], 1)
    checks = {
        "volume": (f["gold_rows"], f["gold_rows"] > min_rows),
        "retention": (retention, retention > min_retention),
        "unique": (f["duplicates"], f["duplicates"] == 0),
        "complete": (f["undated"], f["undated"] == 0),
        "domain": (f["implausible"], f["implausible"] == 0),
        "distribution": (concentration, concentration < max_decade_share),
    }
    rows = [
        F.struct(
            F.lit(gate).alias("gate"),
            value.cast("double").alias("value"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )
        for gate, (value, passed) in checks.items()
    ]
    return gate_figures(gold, bronze_entities, as_of).select(F.inline(F.array(*rows)))


def enforce(report: DataFrame) -> list[tuple[str, float | None, bool]]:
    """Log every gate, then raise if any did not pass, naming all of them."""
    rows = [(r["gate"], r["value"], r["passed"]) for r in report.collect()]
    for gate, value, passed in rows:
        log.info("[%s] %s: %s", "ok" if passed else "FAILED", gate, value)
    failed = [gate for gate, _, passed in rows if not passed]
    if failed:
        raise GateFailure(failed)
    return rows


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that break uniqueness; a mart or code table must have none."""
    return repeated_keys(df, *keys)


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    """Pass ``df`` through when its keys are unique, else raise."""
    sample = repeated_keys(df, *keys).limit(5).collect()
    if sample:
        shown = "; ".join(str(tuple(r[k] for k in keys)) for r in sample)
        raise GateFailure([f"duplicate {', '.join(keys)}: {shown}"])
    return df
