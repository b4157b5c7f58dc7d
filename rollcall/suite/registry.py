"""Collects the bound queries and their checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollcall.suite.binding import Star, portable, with_views

Build = Callable[[Star], DataFrame]

_cases: dict[str, tuple[Build, str | None]] = {}


def case(key: str, sql: str | None) -> Callable[[Build], Build]:
    """Register a query under a key with the SQL that must give the same rows."""

    def keep(build: Build) -> Build:
        if key in _cases:
            raise ValueError(f"two cases named {key}")
        _cases[key] = (build, sql)
        return build

    return keep


def _bound(build: Build) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(build(Star(spark, folder)))

    return run


def _load() -> None:
    from rollcall.suite import operators, plans, sources  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {key: _bound(build) for key, (build, _) in _cases.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {key: with_views(sql) for key, (_, sql) in _cases.items() if sql is not None}
