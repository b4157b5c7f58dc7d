"""Changes of gold: signed rows, sums kept up to date, gold laid out by identifier."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rollcall import load, schemas
from rollcall.plans import changes, gates, marts
from rollcall.session import stage
from rollcall.sources import tables

AS_OF = "2026-02-01"
SETTINGS = dict(as_of=AS_OF, min_sector=1, min_rows=0, min_retention=0, max_decade_share=101)


def entity(rng, number):
    opened = dt.date(1985, 1, 1) + dt.timedelta(rng.randrange(14_000))
    status = rng.choice([2, 2, 8, 8, None])
    ended = opened + dt.timedelta(rng.randrange(-50, 3000)) if status == 8 else None
    return (
        f"{number:08d}", f"E{number}", 2062, rng.choice([None, Decimal("0.00"), Decimal(rng.randrange(10**7)) / 100]),
        opened, rng.choice([None, 111301, 4711301, 4711302]), rng.choice([None, 7107, 6001, 6002]),
        rng.choice([None, "SP", "RJ"]), status, ended,
    )


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def states(spark):
    """Gold before and after: 40 rows gone, 60 changed, 50 new, some changed in their name alone."""
    rng = random.Random(7)
    before = {n: entity(rng, n) for n in range(400)}
    after = {n: r for n, r in before.items() if n >= 40}
    changed = {n: entity(rng, n) for n in [*range(100, 160), *range(400, 450)]}
    changed |= {n: (before[n][0], "renamed", *before[n][2:]) for n in range(200, 210)}
    after |= changed
    make = lambda rows: stage(spark.createDataFrame(list(rows), schemas.GOLD), "state")
    gone = spark.createDataFrame([(f"{n:08d}",) for n in [*range(40), 110, 7777]], "entity_id string")
    return make(before.values()), make(after.values()), make(changed.values()), gone


@pytest.fixture(scope="module")
def codes(spark):
    sec = spark.createDataFrame([(111301, "x"), (4711301, "y")], schemas.CODES)
    return sec, spark.createDataFrame([(7107, "z"), (6001, "z")], schemas.CODES)


def all_marts(reg, codes, stored=None):
    built = marts.mart_builders(reg, *codes, min_sector=1, stored=stored)
    return {n: rows_of(b()) for n, b in built.items()}


def seed(spark, gold, codes, prefix, sums=True, buckets=None):
    """A release of gold and its marts, as a load leaves it."""
    keys = {f"{prefix}{n}": k for n, k in marts.MART_KEYS.items()}

    def builders(current, stored=None):
        return {f"{prefix}{n}": b for n, b in marts.mart_builders(current, *codes, min_sector=1, stored=stored).items()}

    made = load.release_of_sums(prefix, marts.CLOSED, marts.ACTIVE, marts.GROWTH_SINCE) if sums else None
    name = f"{prefix}gold"
    return tables.publish_release(
        spark, f"{prefix}release", {
            f"{prefix}quarantine": lambda _: spark.range(1),
            **load.release_of_gold(name, gold, builders, keys, made),
        },
        buckets={name: tables.Buckets("entity_id", buckets)} if buckets else None,
    )


def test_difference_makes_new_of_old(spark, states):
    old, new, _, _ = states
    moves = changes.difference(old, new)
    columns = list(changes.MART_COLUMNS)

    def bag(df, sign):
        return df.select(*columns, F.lit(sign).alias(changes.SIGN))

    total = bag(old, 1).unionByName(moves).unionByName(bag(new, -1))
    left = total.groupBy(*columns).agg(F.sum(changes.SIGN).alias("n")).where("n <> 0")
    assert left.count() == 0
    assert moves.count() <= 40 + 2 * 60 + 50  # renamed entities are no change to the marts
    assert changes.difference(new, new).count() == 0
    assert changes.difference(old.limit(0), new).where(f"{changes.SIGN} = 1").count() == new.count()
    assert changes.difference(old.limit(0), new.limit(0)).count() == 0


@pytest.mark.parametrize("how", ["difference", "changes_of"])
def test_merged_sums_are_those_of_a_rebuild(spark, states, codes, how):
    old, new, rows, gone = states
    moves = changes.difference(old, new) if how == "difference" else changes.changes_of(old, rows, gone)
    places, sectors = changes.merged_sums(marts.place_sums(old), marts.sector_sums(old), moves)
    assert places.dtypes == marts.place_sums(new).dtypes and sectors.dtypes == marts.sector_sums(new).dtypes
    assert rows_of(places) == rows_of(marts.place_sums(new))
    assert rows_of(sectors) == rows_of(marts.sector_sums(new))
    assert changes.fits(places, new.count()) and changes.fits(sectors, new.count())
    assert not changes.fits(places, new.count() + 1)
    # A frame that cannot be read stands for gold: marts of stored sums do not touch it.
    broken = new.withColumn("capital", F.raise_error(F.lit("gold was read")).cast("decimal(18,2)"))
    assert all_marts(broken, codes, (places, sectors)) == all_marts(new, codes)


def test_changes_that_undo_everything_leave_no_group(spark, states):
    old, _, _, _ = states
    moves = changes.difference(old, old.limit(0))
    for sums in changes.merged_sums(marts.place_sums(old), marts.sector_sums(old), moves):
        assert sums.count() == 0 and changes.fits(sums, 0)


def test_sums_of_another_gold_do_not_fit(spark, states):
    old, new, _, _ = states
    moves = changes.difference(old, new)
    other = old.where("sector_code IS NULL")
    _, sectors = changes.merged_sums(marts.place_sums(other), marts.sector_sums(other), moves)
    assert not changes.fits(sectors, sectors.agg(F.sum("n")).first()[0])  # some count is negative


@pytest.mark.parametrize("buckets", [None, 4])
def test_a_release_of_changes(spark, states, codes, buckets):
    old, new, rows, gone = states
    prefix = f"chg{buckets or 0}_"
    first = seed(spark, old, codes, prefix, buckets=buckets)
    assert load.run_changes(spark, rows, *codes, gone=gone, prefix=prefix, buckets=buckets, **SETTINGS)
    opened = tables.open_release(spark, f"{prefix}release")
    assert rows_of(opened[f"{prefix}gold"]) == rows_of(new)
    expected = all_marts(new, codes)
    assert {n: rows_of(opened[f"{prefix}{n}"]) for n in expected} == expected
    manifest = tables.manifest(spark, f"{prefix}release")
    assert manifest[f"{prefix}quarantine"] == first[f"{prefix}quarantine"]
    # Nothing changes, then other settings: the sums are made anew.
    none = rows.limit(0)
    assert load.run_changes(spark, none, *codes, prefix=prefix, buckets=buckets, **SETTINGS)
    assert not load.run_changes(spark, none, *codes, prefix=prefix, buckets=buckets, **SETTINGS, active=8)
    kpis = tables.read_mart(spark, f"{prefix}mart_region_kpis")
    assert rows_of(kpis) == rows_of(marts.region_kpis(new, active=8))


def test_sums_that_are_missing_or_wrong_are_made_anew(spark, states, codes):
    old, new, rows, gone = states
    seed(spark, old, codes, "wrong_", sums=False)
    assert not load.run_changes(spark, rows, *codes, gone=gone, prefix="wrong_", **SETTINGS)
    name = tables.manifest(spark, "wrong_release")["wrong_sums_places"]
    stored = [tuple(r) for r in spark.table(name).collect()]
    spark.createDataFrame(stored[1:], spark.table(name).schema).write.mode("overwrite").saveAsTable(name)
    assert not load.run_changes(spark, rows.limit(0), *codes, prefix="wrong_", **SETTINGS)
    expected = all_marts(new, codes)
    assert {n: rows_of(spark.table(f"wrong_{n}")) for n in expected} == expected


def test_a_failed_gate_keeps_the_release(spark, states, codes):
    old, _, rows, gone = states
    seed(spark, old, codes, "kept_")
    before = tables.manifest(spark, "kept_release")
    lenient = SETTINGS | dict(min_retention=99)
    with pytest.raises(gates.GateFailure, match="retention"):
        load.run_changes(spark, rows.limit(0), *codes, gone=gone, prefix="kept_", **lenient)
    twice = rows.unionByName(rows)
    with pytest.raises(gates.GateFailure, match="unique"):
        load.run_changes(spark, twice, *codes, gone=gone, prefix="kept_", **SETTINGS)
    assert tables.manifest(spark, "kept_release") == before
    assert all(tables.versions(spark, n) == [v] for n, v in before.items())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_in_buckets_is_grouped_and_compared_without_an_exchange(spark, states):
    old, new, _, _ = states
    layout = tables.Buckets("entity_id", 4)
    was = tables.publish(old, "bucketed_old", buckets=layout)
    now = tables.publish(new, "bucketed_new", buckets=layout)
    assert rows_of(was) == rows_of(old)
    by_id = plan_of(gates.count_by(now, "entity_id"))
    assert "Exchange" not in by_id and "Bucketed: true" in by_id
    assert "Exchange" in plan_of(gates.count_by(new, "entity_id"))
    assert "Exchange" not in plan_of(changes.difference(was, now))
    # The gates themselves: what is exchanged are decades and single rows, never identifiers.
    assert "hashpartitioning(entity_id" not in plan_of(gates.gate_figures(now, old))
    assert gates.gate_figures(now, old).collect() == gates.gate_figures(new, old).collect()


def test_gold_is_built_in_its_buckets(spark, tmp_path):
    ent = spark.range(1000).select(
        F.col("id").cast("string").alias("cnpj_basico"), F.lit("n").alias("razao_social"),
        F.lit("2062").alias("natureza_juridica"), F.lit("1,00").alias("capital_social"))
    est = spark.range(1000).select(
        F.col("id").cast("string").alias("cnpj_basico"), F.lit("1").alias("matriz_filial"),
        F.lit("20100101").alias("data_inicio_atividade"), F.lit("1").alias("cnae_fiscal"),
        F.lit("1").alias("municipio"), F.lit("SP").alias("uf"), F.lit("2").alias("situacao_cadastral"),
        F.lit("0").alias("data_situacao"))
    from rollcall.plans.gold import build_gold

    rows = build_gold(ent, est, AS_OF, buckets=5)
    published = tables.publish(rows, "built_gold", buckets=tables.Buckets("entity_id", 5, spread=False))
    assert len(published.inputFiles()) == 5 and published.count() == 1000
    assert rows_of(published) == rows_of(build_gold(ent, est, AS_OF))


def test_the_bound_registry_is_joined_once(spark, monkeypatch):
    """An earlier registry, what changed since and all that is published of them come from one reading."""
    from rollcall.suite.binding import Star

    folder = "/root/testdata/sf0.001"
    star, made = Star(spark, folder), spark.sparkContext.accumulator(0)
    reg = star.reg

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    star.__dict__["reg"] = reg.mapInArrow(counted, reg.schema)
    monkeypatch.setattr("rollcall.suite.binding._changed", {})
    changed = star.changed()
    assert made.value == reg.count()
    assert changed["gold"].exceptAll(reg).count() == 0 == reg.exceptAll(changed["gold"]).count()


def test_rows_that_came_are_written_once(spark, tmp_path, monkeypatch):
    from rollcall.suite.binding import Star

    written, stage = {}, load.stage

    def kept(df, stem):
        written[stem] = stage(df, stem)
        return written[stem]

    monkeypatch.setattr(load, "stage", kept)
    monkeypatch.setattr("rollcall.suite.binding._changed", {})
    Star(spark, "/root/testdata/sf0.001").changed()
    came = written["changed-rows"].count()
    others = [df.count() for stem, df in written.items() if not stem.startswith(("changed-rows", "merged"))]
    assert others and came > 0 and sum(others) < came
