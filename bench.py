"""Headline timings as one JSON line.

BENCH_SF_DIR    folder of tables (default /root/testdata/sf0.1)
BENCH_CPUS      local cores (default all)
BENCH_RUNS      timed runs per query after one warm-up; the mean is reported (default 5)
BENCH_COPIES    entities per order, to time the queries on a registry that many times larger
                (default 1; 445 at sf0.1 gives 66.75 million entities)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rollcall.plans import compare, gates, marts, metrics, quality, report, strategic  # noqa: E402
from rollcall.plans.gold import build_gold, quarantine_count  # noqa: E402
from rollcall.session import build_session  # noqa: E402
from rollcall.sources import tables  # noqa: E402
from rollcall.suite.binding import (  # noqa: E402
    ACTIVE,
    AS_OF,
    CLOSED,
    DUE_UFS,
    MAX_DECADE,
    MIN_ROWS,
    MIN_SECTOR,
    SINCE,
    Star,
)


def copies(df: DataFrame, n: int, id_column: str, *day_columns: str) -> DataFrame:
    """Every row ``n`` times, each copy with an identifier of its own and shifted days."""
    if n == 1:
        return df
    number = F.col(id_column).cast("bigint") * n + F.col("copy")
    shift = {c: F.date_sub(F.col(c), F.col("copy").cast("int")) for c in day_columns}
    # Small tables come in one file; without this one task would make all copies. A task makes about
    # 250,000 rows, whatever the size.
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() * n // 250_000))
    made = df.repartition(tasks).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    made = made.withColumns({**shift, id_column: F.lpad(number.cast("string"), 8, "0")})
    return made.drop("copy")


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    n_copies = int(os.environ.get("BENCH_COPIES", "1"))
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session(
        "rollcall-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(int(cpus) * (1 if n_copies == 1 else 8)),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": f"{scratch}/shared",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.local.dir": f"{scratch}/local",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    star = Star(spark, folder)
    sec, mun = star.sec, star.mun
    seconds: dict[str, float] = {}

    # Load: raw text columns -> typed, joined, gated gold; then the published registry and its marts.
    # A first small load warms the JVM, as the query warm-up does below.
    star.etl_gold().count()
    # An order has four lines on average: this makes establishments as many as entities are below.
    n_raw = max(1, n_copies // 4)
    seconds["etl_bronze"] = timed(
        lambda: tables.load_bronze(
            spark,
            {
                "bench_entity": lambda: copies(star.ent, n_raw, "cnpj_basico"),
                "bench_establishment": lambda: copies(star.est, n_raw, "cnpj_basico"),
            },
        )
    )
    ent, est = spark.table("bench_entity"), spark.table("bench_establishment")
    seconds["etl_quarantine"] = timed(lambda: quarantine_count(est, AS_OF).collect())
    seconds["etl_gold"] = timed(
        lambda: tables.publish(build_gold(ent, est, AS_OF), "bench_etl_gold")
    )
    seconds["etl_gates"] = timed(
        lambda: gates.run_gates(
            spark.table("bench_etl_gold"), ent, min_rows=MIN_ROWS, as_of=AS_OF
        ).collect()
    )
    published = copies(star.reg, n_copies, "entity_id", "opened", "status_date")
    reg = tables.publish(published, "bench_registry")
    seconds["gates_registry"] = timed(
        lambda: gates.run_gates(
            reg, reg, min_rows=MIN_ROWS, max_decade_share=MAX_DECADE, as_of=AS_OF
        ).collect()
    )
    since = "1990-01-01" if n_copies > 1 else SINCE
    builders = marts.mart_builders(
        reg, sec, mun, closed=CLOSED, active=ACTIVE, min_sector=MIN_SECTOR, since=since
    )
    seconds["marts_refresh"] = timed(lambda: tables.refresh_marts(spark, builders))

    def mart(name):
        return tables.read_mart(spark, name)

    survival = builders["mart_survival_sector"]
    queries = {
        "rank_capital": lambda: strategic.rank_capital(reg, sec, mun),
        "survival_by_sector": survival,
        "survival_top20_mart": lambda: marts.longest_lived(mart("mart_survival_sector")),
        "treemap_raw": lambda: marts.division_totals(reg),
        "treemap_mart": lambda: marts.treemap_ordered(mart("mart_treemap")),
        "bubbles_raw": lambda: marts.bubbles(reg, mun),
        "bubbles_top10_mart": lambda: marts.bubbles_top_years(mart("mart_bubbles")),
        "growth_raw": lambda: marts.growth_by_muni(reg, mun, since),
        "growth_mart": lambda: marts.growth_series(mart("mart_growth_muni")),
        "count_by_muni": lambda: marts.count_by_muni(reg),
        "strategic_sample": lambda: strategic.strategic(reg, sec, mun, limit=strategic.SAMPLE_ROWS),
        "strategic_any_rows": lambda: strategic.strategic(
            reg, sec, mun, limit=strategic.SAMPLE_ROWS, repeatable=False
        ),
        "strategic_kpis_full": lambda: strategic.indicators(strategic.selection(reg, sec, mun)),
        "data_quality": lambda: quality.data_quality(reg, sec, AS_OF),
        "regions_available": lambda: compare.regions_available(reg, mun),
        "sector_share_region": lambda: compare.compare_sectors(reg, "uf", DUE_UFS),
        "kpi_region": lambda: compare.compare_kpis(reg, "uf", DUE_UFS),
        "age_all": lambda: metrics.ages(reg, AS_OF),
        "survival_global": lambda: metrics.survival_global(reg, CLOSED),
        "status_share": lambda: metrics.status_share(reg),
        "decade_share": lambda: metrics.decade_share(reg),
        "capital_bands": lambda: report.capital_bands(reg),
        "capital_by_nature": lambda: report.capital_by_nature(reg, star.nat),
    }
    for name, build in queries.items():
        timed(lambda: build().collect())
        seconds[name] = sum(timed(lambda: build().collect()) for _ in range(runs)) / runs

    digits = "".join(c for c in os.path.basename(folder.rstrip("/")) if c.isdigit() or c == ".")
    print(json.dumps({
        "metric": "registry_load_and_queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in seconds.items()},
        "sf": float(digits) if digits else folder,
        "entities": reg.count(),
        "cpus": int(cpus),
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
