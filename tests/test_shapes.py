"""What the physical plans do: push down, prune, shuffle only what is aggregated."""

import re

import pytest
from pyspark.sql import functions as F

from rollcall.plans import compare, gold, marts, metrics, quality, report, strategic
from rollcall.suite.binding import Star

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    return Star(spark, FOLDER)


@pytest.fixture(scope="module")
def reg(spark, star, tmp_path_factory):
    """Gold as stored."""
    path = str(tmp_path_factory.mktemp("gold") / "gold")
    star.reg.repartition(4).write.parquet(path)
    return spark.read.parquet(path)


def scans(df) -> list[set[str]]:
    """Columns read by each scan of gold."""
    found = re.findall(r"ReadSchema: struct<([^>]*)>", plan(df))
    return [set(re.findall(r"(\w+):", s)) for s in found]


@pytest.mark.parametrize("build, columns", [
    (lambda r, s: marts.survival_by_sector(r, s.sec, closed="F"),
     {"opened", "sector_code", "status", "status_date"}),
    (lambda r, s: marts.growth_by_muni(r, s.mun), {"opened", "muni_code"}),
    (lambda r, s: marts.bubbles(r, s.mun), {"opened", "muni_code", "capital"}),
    (lambda r, s: marts.count_by_muni(r), {"muni_code"}),
    (lambda r, s: quality.data_quality(r, s.sec), {"capital", "opened", "sector_code"}),
    (lambda r, s: compare.compare_sectors(r, "uf", ["ASIA", "EUROPE"]), {"uf", "sector_code"}),
    (lambda r, s: compare.regions_available(r, s.mun), {"muni_code"}),
    (lambda r, s: metrics.ages(r), {"opened"}),
    (lambda r, s: report.capital_by_nature(r, s.nat), {"capital", "legal_nature"}),
])
def test_facts_are_read_once_and_only_where_needed(reg, star, build, columns):
    gold_scans = [c for c in scans(build(reg, star)) if c & set(reg.columns)]
    assert gold_scans == [columns]


@pytest.mark.parametrize("build", [
    lambda r, s: marts.survival_by_sector(r, s.sec, closed="F"),
    lambda r, s: marts.growth_by_muni(r, s.mun),
    lambda r, s: marts.bubbles(r, s.mun),
    lambda r, s: marts.division_totals(r),
    lambda r, s: quality.data_quality(r, s.sec),
    lambda r, s: compare.compare_sectors(r, "uf", ["ASIA", "EUROPE"]),
    lambda r, s: metrics.ages(r),
    lambda r, s: report.capital_by_nature(r, s.nat),
])
def test_facts_are_aggregated_before_any_shuffle_or_join(reg, star, build):
    # In the printed tree a scan is below what consumes it: walk up from the scan of gold.
    lines = plan(build(reg, star)).splitlines()
    at = next(i for i, line in enumerate(lines) if "capital" in line and "FileScan" in line
              or "FileScan" in line and re.search(r"opened|muni_code|sector_code|uf#", line))
    above = [line for line in reversed(lines[:at])]
    first = next(line for line in above
                 if re.search(r"HashAggregate|Exchange|Join|Window", line))
    assert "HashAggregate" in first and "partial_" in first


def test_filters_reach_the_scan(reg, star):
    text = plan(marts.survival_by_sector(reg, star.sec, closed="F"))
    assert "EqualTo(status,F)" in text
    assert "GreaterThanOrEqual(opened,1990-01-01)" in plan(marts.growth_by_muni(reg, star.mun))
    assert "GreaterThan(capital,0.00)" in plan(report.capital_stats(reg))
    text = plan(compare.compare_kpis(reg, "uf", ["ASIA", "EUROPE"]))
    assert "In(uf, [ASIA,EUROPE])" in text


def test_region_prefixes_and_dates_reach_the_scan(spark, reg, star):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        text = plan(compare.compare_kpis(reg, "prefix", ["11", "21"]))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = re.search(r"PushedFilters: (.*)", text)[1]
    assert "GreaterThanOrEqual(muni_code,110)" in pushed and "LessThanOrEqual(muni_code,219)" in pushed
    text = plan(compare.growth_by_state(reg, ["ASIA", "EUROPE"], 1997))
    assert "GreaterThanOrEqual(opened,1997-01-01)" in text and "In(uf, [ASIA,EUROPE])" in text


def test_all_marts_come_from_two_readings_of_the_facts(reg, star, monkeypatch):
    made = []
    stage = marts.stage
    monkeypatch.setattr(marts, "stage", lambda df, stem: made.append(stem) or stage(df, stem))
    builders = marts.mart_builders(reg, star.sec, star.mun, closed="F", active="O", min_sector=3)
    facts = {"capital", "opened", "status_date"}
    for build in builders.values():
        mart = build()
        mart.collect()
        assert not [c for c in scans(mart) if c & (facts - {"capital"})]
    assert sorted(made) == ["place-sums", "sector-sums"]


def test_ranking_is_a_topk_with_its_floor_pushed(reg, star):
    text = plan(strategic.rank_capital(reg, star.sec, star.mun))
    assert "TakeOrderedAndProject(limit=25" in text
    assert "GreaterThanOrEqual(capital,ScalarSubquery" in text


def test_top_years_come_from_one_reading_without_a_join(spark, reg, star, tmp_path):
    marts.bubbles(reg, star.mun).write.parquet(str(tmp_path / "mart"))
    df = marts.bubbles_top_years(spark.read.parquet(str(tmp_path / "mart")))
    df.collect()
    text = plan(df).split("== Initial Plan ==")[0]
    assert len(scans(df)) >= 1 and text.count("FileScan parquet") == 1
    assert "Join" not in text and text.count("Exchange") <= 2, text


def test_sample_is_cut_before_its_limit(reg, star):
    text = plan(strategic.strategic(reg, star.sec, star.mun, limit=strategic.SAMPLE_ROWS))
    assert re.search(r"Filter .*substring\(entity_id#\d+, 1, 4\) <= \d+", text)


def test_unused_lines_are_not_joined(star):
    text = plan(metrics.status_share(star.reg))
    assert "l_orderkey" not in text


def test_gold_join_moves_only_needed_columns(star):
    text = plan(gold.build_gold(star.ent, star.est, "2002-01-01"))
    assert "EqualTo(l_linenumber" in text or "l_linenumber" in text
    assert "l_tax" not in text and "o_orderpriority" not in text


def test_no_python_in_any_query_plan(spark):
    import __spark_entry__ as bound

    for key, build in bound.queries().items():
        text = plan(build(spark, FOLDER))
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|CartesianProduct", text), key


def test_no_broadcast_above_the_threshold(spark, reg, star):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (
            marts.survival_by_sector(reg, star.sec, closed="F"),
            strategic.strategic(reg, star.sec, star.mun, "PROMO Brand#7", limit=strategic.SAMPLE_ROWS),
            strategic.rank_capital(reg, star.sec, star.mun),
            gold.build_gold(star.ent, star.est, "2002-01-01"),
        ):
            assert "BroadcastHashJoin" not in plan(df)
            df.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_hot_identifier_keeps_every_pair(spark, star):
    """A third of all establishments share one identifier; the join must keep every pair."""
    est = star.est.withColumn(
        "cnpj_basico",
        F.when(F.xxhash64("cnae_fiscal", "data_situacao", "municipio") % 3 == 0, F.lit("7"))
        .otherwise(F.col("cnpj_basico")),
    )
    df = gold.build_gold(star.ent, est, "2002-01-01")
    valid, _ = gold.split_quarantine(est, "2002-01-01")
    hot = valid.where(F.col("cnpj_basico") == "7").count()
    assert hot > 100
    assert df.where(F.col("entity_id") == "00000007").count() == hot
    assert df.count() == valid.count()
