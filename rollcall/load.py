"""A whole load as one call: raw tables, quarantine, gold behind its gates, marts."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.plans import changes, gates, gold, marts, strategic
from rollcall.session import stage
from rollcall.sources import tables

log = logging.getLogger(__name__)

# Tables of the sums behind the marts, and the column that says with which settings they were made.
PLACES, SECTORS, SETTINGS = "sums_places", "sums_sectors", "made_with"
# Table of the entities with the most capital, for rankings.
TOP = "top_capital"


def run_load(
    spark: SparkSession,
    sources: Mapping[str, Callable[[], DataFrame]],
    sec: DataFrame,
    mun: DataFrame,
    *,
    prefix: str = "",
    as_of: dt.date | str | None = None,
    reuse_bronze: bool = False,
    keep: int = tables.KEEP,
    closed: Any = marts.CLOSED,
    active: Any = marts.ACTIVE,
    min_sector: int = marts.MIN_SECTOR_SIZE,
    since: dt.date | str = marts.GROWTH_SINCE,
    together: bool = True,
    sums: bool = False,
    buckets: int | None = None,
    top: bool = False,
    **thresholds: float,
) -> list[str]:
    """Load entities and establishments and publish everything made of them.

    ``sources`` names and reads the two raw tables, entities first. Published under ``prefix``: the rows
    set aside (``quarantine``) with the reasons (``quarantine_reasons``), ``gold`` if its gates pass, and
    all marts. Each table keeps its last ``keep`` versions.

    All of it is one release, ``release`` (``tables.open_release``): a gate or a mart that fails raises and
    leaves every table as it was. With ``together=False`` tables are published one after another: a failed
    gate leaves gold and marts as they were, a mart that fails keeps its old version and stops no other, and
    the names of such marts are returned.

    ``sums`` publishes in the release what :func:`run_changes` adds changes to. ``buckets`` lays gold out by
    identifier, so that its gate of unique identifiers and later joins on them shuffle nothing. ``top``
    publishes in the release the slice of gold that capital rankings ask first.
    """
    if (sums or top) and not together:
        raise ValueError("sums and the slice for rankings are published in a release only")
    landed = list(tables.load_bronze(spark, sources, reuse=reuse_bronze).values())
    entities, establishments = landed
    _, aside = gold.split_quarantine(establishments, as_of)
    reasons = gold.quarantine_reasons(entities, establishments, as_of)
    rows = gold.build_gold(entities, establishments, as_of, buckets)
    layout = None if buckets is None else tables.Buckets("entity_id", buckets, spread=False)

    def report(current: DataFrame) -> DataFrame:
        return gates.run_gates(current, entities, as_of=as_of, **thresholds)

    def builders(
        current: DataFrame, stored: tuple[DataFrame, DataFrame] | None = None
    ) -> dict[str, Callable[[], DataFrame]]:
        return named(marts.mart_builders(
            current, sec, mun, closed=closed, active=active, min_sector=min_sector, since=since, stored=stored
        ))

    def named(builders: Mapping[str, Any]) -> dict[str, Any]:
        return {f"{prefix}{n}": b for n, b in builders.items()}

    keys = named(marts.MART_KEYS)
    if not together:
        tables.publish(aside, f"{prefix}quarantine", order=(), keep=keep)
        tables.publish(reasons, f"{prefix}quarantine_reasons", order=(), keep=keep)
        return tables.publish_with_marts(rows, f"{prefix}gold", report, builders, keys, keep, layout)
    made = release_of_sums(prefix, closed, active, since) if sums else {}
    tables.publish_release(
        spark,
        f"{prefix}release",
        {
            f"{prefix}quarantine": lambda _: aside,
            f"{prefix}quarantine_reasons": lambda _: reasons,
            **release_of_gold(f"{prefix}gold", rows, builders, keys, made),
            **(release_of_top(prefix) if top else {}),
        },
        checks=release_checks(f"{prefix}gold", report, keys),
        order={f"{prefix}gold": ("opened",)},
        buckets={f"{prefix}gold": layout} if layout else None,
        keep=keep,
    )
    return []


def run_changes(
    spark: SparkSession,
    rows: DataFrame,
    sec: DataFrame,
    mun: DataFrame,
    *,
    gone: DataFrame | None = None,
    prefix: str = "",
    as_of: dt.date | str | None = None,
    keep: int = tables.KEEP,
    closed: Any = marts.CLOSED,
    active: Any = marts.ACTIVE,
    min_sector: int = marts.MIN_SECTOR_SIZE,
    since: dt.date | str = marts.GROWTH_SINCE,
    buckets: int | None = None,
    **thresholds: float,
) -> bool:
    """Publish the next release from the one that :func:`run_load` left and what has changed since.

    ``rows`` of gold (:func:`gold.build_gold` of the extracts of changed entities) take the place of rows of the
    same identifier or are new, those with an identifier in ``gone`` go. Gold is copied without what is touched;
    the sums behind the marts grow by the changes alone, and marts are made of these sums. The retention gate
    asks what share of the rows before is there now. Quarantine and reasons stay those of the last load.

    Returns True when sums were kept up to date. They are made anew from gold, and False is returned, when the
    release has none, when they were made with other settings, or when they do not fit gold after the changes.
    """
    name = f"{prefix}gold"
    before = tables.manifest(spark, f"{prefix}release")
    old = spark.table(before[name])
    rows = stage(rows.select(*old.columns), "changed-rows")
    # Rows that came are written already: only those that went are written beside them.
    moves = changes.signed_changes(stage(changes.rows_before(old, rows, gone), "went"), rows)
    made = release_of_sums(prefix, closed, active, since)
    kept = all(s in before for s in made) and all(
        made_with(spark.table(before[s])) in (None, _settings(closed, active, since)) for s in made
    )
    if kept:
        stored = [spark.table(before[s]).drop(SETTINGS) for s in made]
        after = [
            stage(df, "merged-sums")
            for df in changes.merged_sums(*stored, moves, closed=closed, active=active, since=since)
        ]
        growth = moves.agg(F.coalesce(F.sum(changes.SIGN), F.lit(0))).first()[0]
        total = old.count() + growth
        kept = all(changes.fits(df, total) for df in after)
        if kept:
            stamp = F.lit(_settings(closed, active, since)).alias(SETTINGS)
            made = {s: lambda _, df=df: df.select("*", stamp) for s, df in zip(made, after)}
        else:
            log.warning("sums of %s do not fit its changes: made anew", name)

    def report(current: DataFrame) -> DataFrame:
        return gates.run_gates(current, old, as_of=as_of, **thresholds)

    def builders(current: DataFrame, stored: tuple[DataFrame, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
        found = marts.mart_builders(
            current, sec, mun, closed=closed, active=active, min_sector=min_sector, since=since, stored=stored
        )
        return {f"{prefix}{n}": b for n, b in found.items()}

    keys = {f"{prefix}{n}": k for n, k in marts.MART_KEYS.items()}
    layout = None if buckets is None else tables.Buckets("entity_id", buckets, spread=False)
    after_all = changes.after_changes(old, rows, gone, buckets=buckets)
    tables.publish_release(
        spark,
        f"{prefix}release",
        {
            **release_of_gold(name, after_all, builders, keys, made),
            **(release_of_top(prefix) if f"{prefix}{TOP}" in before else {}),
        },
        checks=release_checks(name, report, keys),
        order={name: ("opened",)},
        buckets={name: layout} if layout else None,
        carry=before,
        keep=keep,
    )
    return kept


def _settings(closed: Any, active: Any, since: dt.date | str) -> str:
    return f"closed={closed} active={active} since={since}"


def made_with(sums: DataFrame) -> str | None:
    """Settings of stored sums; None when there are no groups, which fit any."""
    row = sums.select(SETTINGS).first()
    return row and row[0]


def release_of_sums(
    prefix: str, closed: Any, active: Any, since: dt.date | str
) -> dict[str, Callable[[Callable[[str], DataFrame]], DataFrame]]:
    """Both groupings behind the marts for a release, made from the version of gold it has written."""
    stamp = F.lit(_settings(closed, active, since)).alias(SETTINGS)

    def facts(read: Callable[[str], DataFrame]) -> DataFrame:
        return read(f"{prefix}gold")

    return {
        f"{prefix}{PLACES}": lambda read: marts.place_sums(facts(read), active, since).select("*", stamp),
        f"{prefix}{SECTORS}": lambda read: marts.sector_sums(facts(read), closed).select("*", stamp),
    }


def release_of_top(prefix: str) -> dict[str, Callable[[Callable[[str], DataFrame]], DataFrame]]:
    """The slice for capital rankings, of the version of gold a release has written."""
    return {f"{prefix}{TOP}": lambda read: strategic.capital_slice(read(f"{prefix}gold"))}


def release_of_gold(
    name: str,
    rows: DataFrame,
    builders: Callable[..., Mapping[str, Callable[[], DataFrame]]],
    marts_of: Iterable[str],
    sums: Mapping[str, Callable[[Callable[[str], DataFrame]], DataFrame]] | None = None,
) -> dict[str, Callable[[Callable[[str], DataFrame]], DataFrame]]:
    """Gold and its marts for a release: the marts are built from the version of gold it has written.

    With ``sums``, two tables of the release too, ``builders`` are also given these as written.
    """
    built: dict[str, Callable[[], DataFrame]] = {}
    sums = sums or {}

    def mart(one: str) -> Callable[[Callable[[str], DataFrame]], DataFrame]:
        def build(read: Callable[[str], DataFrame]) -> DataFrame:
            if not built:
                stored = [tuple(read(s).drop(SETTINGS) for s in sums)] if sums else []
                built.update(builders(read(name), *stored))
            return built[one]()

        return build

    return {name: lambda _: rows, **sums, **{one: mart(one) for one in marts_of}}


def release_checks(
    name: str, report: Callable[[DataFrame], DataFrame], keys: Mapping[str, Iterable[str]]
) -> dict[str, Callable[[DataFrame], object]]:
    """Gates of gold, and unique keys of its marts."""
    unique = {
        one: lambda rows, columns=tuple(columns): gates.require_unique(rows, *columns)
        for one, columns in keys.items()
    }
    return {name: lambda rows: gates.enforce(report(rows)), **unique}
