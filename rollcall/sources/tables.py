"""Published tables: versions, views that name the current one, and mart refresh.

A table is published in two steps. Its rows are written as a new version; a view of the table's
name is then replaced to read that version. Readers keep the old version until the view changes, and
a version that fails its gates is dropped and never named by the view. Versions are tables of the
session's catalogue and lie in its warehouse, not in the scratch folder; the last few are kept.

Tables that belong together are published as a *release*: versions of all are written and checked, then one
view, the manifest, is replaced, which names the version of each. Readers that open the release see all old
versions or all new ones, whatever fails and whenever they come.
"""

from __future__ import annotations

import datetime as dt
import logging
import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.plans.gates import enforce, require_unique

log = logging.getLogger(__name__)

# Versions of a table that stay, the current one included.
KEEP = 2


@dataclass(frozen=True)
class Buckets:
    """Rows of a table laid out by the hash of a column: grouping by it and joining on it need no exchange.

    With ``spread`` rows are shuffled into their buckets before they are written, one file each. Without it
    they must lie so already, as after a join on the column in as many partitions, or every task writes a
    file for every bucket it meets. Spark takes up to 100,000 buckets (``spark.sql.sources.bucketing.maxBuckets``).
    """

    column: str
    count: int
    spread: bool = True


def overwrite_table(df: DataFrame, path: str) -> DataFrame:
    """Replace the Parquet table at ``path``."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bronze_ready(spark: SparkSession, *tables: str) -> bool:
    """True when every raw table exists and has rows, so a reload can be skipped."""
    return all(spark.catalog.tableExists(t) and not spark.table(t).isEmpty() for t in tables)


def load_bronze(
    spark: SparkSession,
    sources: Mapping[str, Callable[[], DataFrame]],
    *,
    reuse: bool = False,
) -> dict[str, DataFrame]:
    """Land raw tables as Parquet before anything is validated; reuse them if asked and possible.

    Zipped or multi-line shards are read once, with one task per file, and split evenly from then on.
    """
    if not (reuse and bronze_ready(spark, *sources)):
        for name, read in sources.items():
            _point(spark, name, _write_version(read(), name))
    return {name: spark.table(name) for name in sources}


def _write_version(
    df: DataFrame, name: str, order: Iterable[str] = (), buckets: Buckets | None = None
) -> str:
    """Write a new version and return the name of its table, without pointing the view at it."""
    version = f"{name}_v{dt.datetime.now(dt.timezone.utc):%Y%m%d%H%M%S%f}"
    if buckets is None:
        (df.sortWithinPartitions(*order) if order else df).write.saveAsTable(version)
        return version
    if buckets.spread:
        df = df.repartition(buckets.count, buckets.column)
    writer = df.write.bucketBy(buckets.count, buckets.column)
    (writer.sortBy(*order) if order else writer).saveAsTable(version)
    return version


def versions(spark: SparkSession, name: str) -> list[str]:
    """Tables that hold versions of ``name``, oldest first."""
    found = (r.tableName for r in spark.sql(f"SHOW TABLES LIKE '{name}_v*'").collect())
    return sorted(t for t in found if re.fullmatch(rf"{re.escape(name)}_v\d{{20}}", t))


def _point(spark: SparkSession, name: str, version: str, keep: int = KEEP) -> DataFrame:
    """Make a version the current one and drop those older than the last ``keep``."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    for old in versions(spark, name)[: -max(1, keep)]:
        spark.sql(f"DROP TABLE {old}")
    return spark.table(name)


def publish(
    df: DataFrame,
    name: str,
    gates: Callable[[DataFrame], DataFrame] | None = None,
    order: Iterable[str] = ("opened",),
    keep: int = KEEP,
    buckets: Buckets | None = None,
) -> DataFrame:
    """Write a version of a table, run its gates on what was written, then make it current.

    Rows are sorted by ``order`` inside each file, so that a date filter skips row groups; without
    ``buckets`` the partitioning of the last join is kept and nothing is shuffled for it. When a gate fails the old
    version stays current, the new one is dropped and :class:`GateFailure` is raised.
    """
    spark = df.sparkSession
    version = _write_version(df, name, order, buckets)
    try:
        if gates is not None:
            enforce(gates(spark.table(version)))
    except Exception:
        spark.sql(f"DROP TABLE {version}")
        raise
    return _point(spark, name, version, keep)


def refresh_marts(
    spark: SparkSession,
    builders: Mapping[str, Callable[[], DataFrame]],
    names: Iterable[str] | None = None,
    keys: Mapping[str, Iterable[str]] | None = None,
    keep: int = KEEP,
) -> list[str]:
    """Rebuild marts one by one; one that fails keeps its old version and stops no other.

    A mart whose ``keys`` are not unique fails. The names of those that failed are returned.
    """
    failed = []
    for name in builders if names is None else names:
        version = None
        try:
            version = _write_version(builders[name](), name)
            if keys and name in keys:
                require_unique(spark.table(version), *keys[name])
            _point(spark, name, version, keep)
            log.info("[ok] %s", name)
        except Exception:
            log.exception("[FAILED] %s", name)
            failed.append(name)
            if version is not None:
                spark.sql(f"DROP TABLE IF EXISTS {version}")
    return failed


def publish_release(
    spark: SparkSession,
    release: str,
    builders: Mapping[str, Callable[[Callable[[str], DataFrame]], DataFrame]],
    *,
    checks: Mapping[str, Callable[[DataFrame], object]] | None = None,
    order: Mapping[str, Iterable[str]] | None = None,
    buckets: Mapping[str, Buckets] | None = None,
    carry: Mapping[str, str] | None = None,
    keep: int = KEEP,
) -> dict[str, str]:
    """Write a version of every table, check each, then make all current by one change of the manifest.

    ``builders`` are called in order with a function that reads what this release has written so far. If one
    fails, or a check raises, every version written is dropped and the manifest and all views stay as they
    were. Views of the tables' own names follow the manifest one by one, for readers of a single table.
    Versions to ``carry``, by name, stay in the manifest as they are.
    """
    written: dict[str, str] = {}
    try:
        for name, build in builders.items():
            rows = build(lambda earlier: spark.table(written[earlier]))
            written[name] = _write_version(
                rows, name, (order or {}).get(name, ()), (buckets or {}).get(name)
            )
            if checks and name in checks:
                checks[name](spark.table(written[name]))
    except Exception:
        for version in written.values():
            spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    current = {**(carry or {}), **written}
    rows = ", ".join(f"('{name}', '{version}')" for name, version in current.items())
    spark.sql(f"CREATE OR REPLACE VIEW {release} AS SELECT * FROM VALUES {rows} AS manifest(name, version)")
    for name, version in written.items():
        _point(spark, name, version, keep)
    return current


def manifest(spark: SparkSession, release: str) -> dict[str, str]:
    """Name of the version that a release has now of each of its tables."""
    return {r.name: r.version for r in spark.table(release).collect()}


def open_release(spark: SparkSession, release: str) -> dict[str, DataFrame]:
    """The tables of a release by name, all of the versions that the manifest names now."""
    return {name: spark.table(version) for name, version in manifest(spark, release).items()}


def read_mart(spark: SparkSession, name: str, *columns: str) -> DataFrame:
    mart = spark.table(name)
    return mart.select(*columns) if columns else mart


def publish_with_marts(
    gold: DataFrame,
    name: str,
    gates: Callable[[DataFrame], DataFrame],
    builders: Callable[[DataFrame], Mapping[str, Callable[[], DataFrame]]],
    keys: Mapping[str, Iterable[str]] | None = None,
    keep: int = KEEP,
    buckets: Buckets | None = None,
) -> list[str]:
    """Publish gold, then rebuild every mart from the version published; names of marts that failed."""
    current = publish(gold, name, gates, keep=keep, buckets=buckets)
    return refresh_marts(gold.sparkSession, builders(current), keys=keys, keep=keep)


def row_counts(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """One row per table: its name and number of rows, counted in one job."""
    parts = [
        spark.table(n).agg(F.count(F.lit(1)).alias("linhas")).select(
            F.lit(n).alias("tabela"), "linhas"
        )
        for n in names
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows
