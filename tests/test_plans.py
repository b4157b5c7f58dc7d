"""Analytic queries on small hand-made registries, against brute force where that is easy."""

import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall import schemas
from rollcall.operators import aggregates, filters, joins, topk, windows
from rollcall.plans import compare, gates, marts, metrics, quality, report, strategic

CODES = "codigo bigint, descricao string"


def registry(spark, rows):
    """Gold rows from dicts; absent roles are NULL."""
    names = schemas.GOLD.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schemas.GOLD)


@pytest.fixture(scope="module")
def four(spark):
    """The four-row registry used to specify the strategic view."""
    def row(i, name, capital, opened, sector, muni, uf):
        return {
            "entity_id": f"{i:08d}", "name": name, "capital": Decimal(capital),
            "opened": dt.date.fromisoformat(opened), "sector_code": sector, "muni_code": muni,
            "uf": uf,
        }
    reg = registry(spark, [
        row(1, "Alpha", 500000, "2010-01-15", 6201, 3550308, "SP"),
        row(2, "Beta", 200000, "2015-06-30", 4711, 3550308, "SP"),
        row(3, "Gama", 150000, "2019-11-20", 4711, 3304557, "RJ"),
        row(4, "Delta", 0, "2018-03-01", 6201, 3550308, "SP"),
    ])
    sec = spark.createDataFrame([(6201, "Tecnologia"), (4711, "Varejo")], CODES)
    mun = spark.createDataFrame([(3550308, "São Paulo"), (3304557, "Rio de Janeiro")], CODES)
    return reg, sec, mun


@pytest.mark.parametrize("sector, city, names", [
    (None, None, {"Alpha", "Beta", "Gama"}),
    ("Tecnologia", None, {"Alpha"}),
    (None, "Rio de Janeiro", {"Gama"}),
    ("Varejo", "São Paulo", {"Beta"}),
    ("Tecnologia", "Rio de Janeiro", set()),
    ("' OR '1'='1", None, set()),
])
def test_strategic_filters(four, sector, city, names):
    for limit in (strategic.SAMPLE_ROWS, None):
        df = strategic.strategic(*four, sector, city, limit)
        assert df.columns == ["razao_social", "capital_social", "data_abertura", "setor", "cidade"]
        assert {r["razao_social"] for r in df.collect()} == names


def test_filter_options(four):
    _, sec, mun = four
    assert [r[0] for r in strategic.filter_options(sec).collect()] == ["Tecnologia", "Varejo"]
    assert [r[0] for r in strategic.filter_options(mun.union(mun)).collect()] == [
        "Rio de Janeiro", "São Paulo",
    ]


def test_strategic_indicators(four):
    rows = strategic.sample(strategic.selection(*four), 30_000)
    kpi = strategic.indicators(rows).first()
    assert (kpi.empresas, kpi.capital_total) == (3, Decimal(850000))
    assert kpi.capital_medio == pytest.approx(850000 / 3)
    none = strategic.indicators(rows.where(F.lit(False))).first()
    assert (none.empresas, none.capital_total, none.capital_medio) == (0, None, None)
    years = {r.ano: r.qtd for r in strategic.openings_by_year(rows).collect()}
    assert years == {2010: 1, 2015: 1, 2019: 1}
    cities = strategic.capital_by_city(rows, four[2], 1).collect()
    assert [(r.cidade, r.capital_social) for r in cities] == [("São Paulo", Decimal(700000))]


def test_rank_capital(four):
    rows = strategic.rank_capital(*four, n=2).collect()
    assert [r.razao_social for r in rows] == ["Alpha", "Beta"]
    rows = strategic.rank_capital(*four, n=10, city="São Paulo").collect()
    assert [(r.razao_social, r.setor) for r in rows] == [("Alpha", "Tecnologia"), ("Beta", "Varejo")]


def spans(seed, n, sectors):
    """Random closed life spans with a third of all rows in one sector and a hot day count."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        opened = dt.date(1990, 1, 1) + dt.timedelta(days=rng.randrange(9000))
        days = 365 if rng.random() < 0.3 else rng.randrange(-50, 6000)
        rows.append({
            "entity_id": f"{i:08d}",
            "status": rng.choice([2, 8, 8, 8]),
            "sector_code": sectors[0] if rng.random() < 0.34 else rng.choice([*sectors, None]),
            "opened": opened,
            "status_date": None if rng.random() < 0.05 else opened + dt.timedelta(days=days),
        })
    return rows


def test_survival_against_brute_force(spark):
    rows = spans(1, 3000, [10, 11, 12, 99])
    reg = registry(spark, rows)
    # Two codes share a name, one has none.
    sec = spark.createDataFrame([(10, "Varejo"), (11, "Varejo"), (12, "Outro")], CODES)
    names = {10: "Varejo", 11: "Varejo", 12: "Outro", 99: "CNAE 99", None: None}
    days = defaultdict(list)
    for r in rows:
        if r["status"] == 8 and r["status_date"] and r["status_date"] >= r["opened"]:
            days[names[r["sector_code"]]].append((r["status_date"] - r["opened"]).days)
    got = {r.setor: r for r in marts.survival_by_sector(reg, sec, min_n=1).collect()}
    assert set(got) == set(days)
    for name, values in days.items():
        years = np.array(values) / 365.25
        row = got[name]
        assert row.total == len(values)
        assert row.media == pytest.approx(years.mean(), abs=0.00501)
        for column, p in marts.SECTOR_POINTS.items():
            assert row[column] == pytest.approx(np.quantile(years, p), abs=0.00501)
    largest = max(len(v) for v in days.values())
    kept = marts.survival_by_sector(reg, sec, min_n=largest).collect()
    assert [r.setor for r in kept] == [n for n, v in days.items() if len(v) == largest]
    every = [d for v in days.values() for d in v]
    one = metrics.survival_global(reg).first()
    assert one.baixadas == len(every)
    assert one.p90 == pytest.approx(np.quantile(np.array(every) / 365.25, 0.9), abs=0.0501)
    lost = metrics.closed_discarded(reg).first()
    closed = [r for r in rows if r["status"] == 8]
    assert lost.total_baixadas == len(closed)
    assert lost.sem_data == sum(r["status_date"] is None for r in closed)
    assert lost.sem_data + lost.data_invertida + len(every) == len(closed)


def test_survival_overall_is_weighted(spark):
    shown = spark.createDataFrame([("a", 1, 2.0, 1.0), ("b", 3, 4.0, 3.0)],
                                  "setor string, total long, media double, mediana double")
    row = marts.survival_overall(shown).first()
    assert tuple(row) == (4, 3.5, 2.5)


def test_metrics_of_nothing(spark):
    none = registry(spark, [])
    assert metrics.survival_global(none).first().baixadas == 0
    assert metrics.ages(none, "2020-01-01").collect()[0].media is None
    assert metrics.capital_zero(none).first().pct is None
    assert metrics.universe(none).first().empresas == 0
    total = quality.data_quality(none, spark.createDataFrame([], CODES)).first()
    assert tuple(total) == (0, 0, 0, 0)
    badges = quality.data_quality_badges(quality.data_quality(none, spark.createDataFrame([], CODES)))
    assert [r.pct for r in badges.collect()] == [0.0, 0.0, 0.0]


@pytest.fixture(scope="module")
def towns(spark):
    """Municipalities 1101, 1102, 3501 and an unnamed 3502; two share a name."""
    rows, i = [], 0
    for muni, uf, n in ((1101, "RO", 5), (1102, "RO", 5), (3501, "SP", 9), (3502, "SP", 2),
                        (None, None, 3)):
        for k in range(n):
            i += 1
            rows.append({
                "entity_id": f"{i:08d}", "name": f"E{i}", "muni_code": muni, "uf": uf,
                "capital": Decimal(k * 100), "opened": dt.date(1995 + k % 3, 1, 1),
                "sector_code": 4711 if k % 2 else 6201, "status": 2 if k % 2 else 8,
                "legal_nature": 1 if k % 2 else 2,
            })
    mun = spark.createDataFrame([(1101, "Vila"), (1102, "Vila"), (3501, "Osasco")], CODES)
    return registry(spark, rows), mun


def test_regions_available(towns):
    rows = compare.regions_available(*towns).collect()
    assert [tuple(r) for r in rows] == [
        ("35", 11, "Osasco", "Grupo 35 — Osasco (11)"),
        ("11", 10, "Vila", "Grupo 11 — Vila (10)"),
    ]


def test_munis_top(towns):
    rows = compare.munis_top(*towns, n=3).collect()
    assert [(r.cod_municipio, r.nome_municipio, r.label) for r in rows] == [
        (3501, "Osasco", "Osasco (9)"), (1101, "Vila", "Vila (5)"), (1102, "Vila", "Vila (5)"),
    ]


def test_same_names_merge_by_name_and_stay_apart_by_code(towns):
    reg, mun = towns
    mart = marts.growth_by_muni(reg, mun)
    by_name = marts.largest_munis(mart, 2).collect()
    assert [tuple(r) for r in by_name] == [("Vila", 10), ("Osasco", 9)]
    by_code = marts.largest_munis(mart, 2, by="cod_municipio").collect()
    assert [tuple(r) for r in by_code] == [(3501, 9), (1101, 5)]
    assert {r.cod_municipio for r in marts.growth_of_largest(mart, 1).collect()} == {1101, 1102}
    assert {r.nome_municipio for r in mart.collect()} == {"Vila", "Osasco", "3502"}


def test_bubbles_selection_policies(towns):
    mart = marts.bubbles(*towns)
    assert mart.where("capital_medio <= 0").isEmpty()
    everything = mart.count()
    assert marts.bubbles_selection(mart, []).count() == everything
    assert marts.bubbles_selection(mart).count() == everything
    assert {r.nome_municipio for r in marts.bubbles_selection(mart, n=1).collect()} == {"3502"}
    assert marts.bubbles_selection(mart, ["Osasco"]).count() == 3
    years = {r.ano for r in marts.bubbles_top_years(mart, 1).collect()}
    assert years == {1996}


def test_rows_of_top_groups(spark):
    rows = [("a", 1, None), ("a", 2, "x"), ("b", 3, "y"), ("c", 3, "z"), ("d", None, "n"), (None, 99, "m")]
    df = spark.createDataFrame(rows, "g string, v int, t string").repartition(3)

    def top(n):
        found = topk.rows_of_top_groups(df, "g", F.sum("v"), n)
        assert found.schema.simpleString() == df.schema.simpleString()
        return sorted((tuple(r) for r in found.collect()), key=repr)

    # Three groups have the same sum: the smaller keys first; one without any value comes last.
    assert top(1) == sorted(rows[:2], key=repr)
    assert top(2) == sorted(rows[:3], key=repr)
    assert top(9) == sorted(rows[:5], key=repr)
    assert topk.rows_of_top_groups(df.limit(0), "g", F.sum("v"), 2).collect() == []


def test_comparison_takes_any_number_of_regions(towns):
    reg, mun = towns
    every = {r.cod_uf for r in compare.regions_available(reg, mun).collect()}
    for values in ([], ["35"], ["35", "35"], ["11", "35", "41", "42", "43", "99"]):
        kpis = compare.compare_kpis(reg, "prefix", values)
        assert {r.cod_uf for r in kpis.collect()} == every & set(values)
        shares = compare.compare_sectors(reg, "prefix", values)
        assert {r.cod_uf for r in shares.collect()} <= every & set(values)
    with pytest.raises(ValueError, match="names"):
        compare.compare_kpis(reg, "muni", [1101, 3501])
    with pytest.raises(ValueError, match="by is"):
        compare.compare_kpis(reg, "uf", ["SP", "RO"]).select(compare._region("city"))
    with pytest.raises(ValueError, match="state column"):
        compare.compare_growth(marts.growth_by_muni(reg, mun), "uf", ["SP", "RO"])


def test_compare_kpis(towns):
    reg, mun = towns
    rows = compare.compare_kpis(reg, "prefix", ["11", "35"]).orderBy("cod_uf").collect()
    assert [tuple(r) for r in rows] == [("11", 10, 250.0, "RO"), ("35", 11, 411.11, "SP")]
    bar = compare.capital_bar(compare.compare_kpis(reg, "uf", ["SP", "RO"]), "uf").collect()
    assert [r.uf for r in bar] == ["RO", "SP"]


def test_sector_shares_use_all_divisions(towns):
    reg, _ = towns
    rows = compare.compare_sectors(reg, "uf", ["SP", "RO"], top_n=1).collect()
    # Division 62 leads with 12 of 21 entities; the share is of every division of the state.
    assert [(r.uf, r.divisao, r.pct, r.setor) for r in rows] == [
        ("RO", "62", 60.0, "TI/Software"), ("SP", "62", 54.55, "TI/Software"),
    ]
    both = compare.compare_sectors(reg, "uf", ["SP", "RO"])
    wide = compare.sector_heatmap(both, "uf", ["SP", "RO"]).collect()
    assert [tuple(r) for r in wide] == [
        ("TI/Software", 54.55, 60.0), ("Comércio Varejista", 45.45, 40.0),
    ]


def test_region_kpis_keep_the_unknown_region(towns):
    rows = {r.cod_uf: r for r in marts.region_kpis(towns[0]).collect()}
    assert set(rows) == {"11", "35", None}
    assert rows["35"].pct_ativas == 45.5 and rows[None].total_empresas == 3


def test_quality_counters(spark, towns):
    reg, _ = towns
    sec = spark.createDataFrame([(4711, "Varejo")], CODES)
    row = quality.data_quality(reg, sec, "1996-06-01").first()
    rows = reg.collect()
    assert row.total == 24
    assert row.capital_invalido == sum(r.capital <= 0 for r in rows)
    assert row.data_invalida == sum(r.opened > dt.date(1996, 6, 1) for r in rows)
    assert row.cnae_nao_mapeado == sum(r.sector_code != 4711 for r in rows)


def test_capital_report(spark, towns):
    reg, _ = towns
    positive = [float(r.capital) for r in reg.collect() if r.capital > 0]
    row = report.capital_stats(reg).first()
    assert (row.total, float(row.soma), float(row.maximo)) == (
        len(positive), sum(positive), max(positive),
    )
    nat = spark.createDataFrame([(1, "Limitada")], CODES)
    assert [r.natureza for r in report.capital_by_nature(reg, nat).collect()] == ["Limitada"]
    bands = report.capital_bands(reg).collect()
    assert [r.empresas for r in bands] == [len(positive), 0, 0, 0]


def test_first_by_key_with_a_hot_prefix(spark):
    rng = random.Random(3)
    ids = [f"{rng.randrange(10**4):08d}" if rng.random() < 0.4 else f"{rng.randrange(10**8):08d}"
           for _ in range(4000)]
    df = spark.createDataFrame([(i,) for i in ids], "entity_id string").repartition(8)
    for n in (1, 700, 2500, 10_000):
        got = [r.entity_id for r in topk.first_by_key(df, "entity_id", n).collect()]
        assert got == sorted(ids)[:n]
    assert topk.first_by_key(df.where(F.lit(False)), "entity_id", 5).count() == 0


def test_first_by_key_with_nulls_and_a_common_prefix(spark):
    ids = [None] * 5 + [f"1234{i:05d}" for i in range(300)]
    df = spark.createDataFrame([(i,) for i in ids], "entity_id string").repartition(4)
    for n in (3, 5, 7, 200, 400):
        got = [r.entity_id for r in topk.first_by_key(df, "entity_id", n).collect()]
        assert got == ids[:n]


def test_largest_rows_fills_up_with_nulls(spark):
    df = spark.createDataFrame([(10, "b"), (None, "c"), (None, "a"), (7, "d")], "v int, k string")
    for n in (1, 2, 3, 4, 9):
        got = [(r.v, r.k) for r in topk.largest_rows(df, n, "v", "k").collect()]
        assert got == [(10, "b"), (7, "d"), (None, "a"), (None, "c")][:n]
    known = topk.largest_rows(df, 4, "v", "k", nulls=False)
    assert [r.v for r in known.collect()] == [10, 7]


def test_spread_is_the_same_from_any_counting(spark):
    rng = random.Random(5)
    values = [rng.choice([7, rng.randrange(500)]) for _ in range(999)]
    df = spark.createDataFrame([(v, v % 3) for v in values], "days int, g int").repartition(7)
    probs = {"a": 0.05, "b": 0.5, "c": 0.9}
    rows = aggregates.spread_of_days(aggregates.count_by(df, "g", "days"), "g", probs=probs)
    for r in rows.collect():
        mine = [v for v in values if v % 3 == r.g]
        assert (r.total, r.sum_days, r.max_days) == (len(mine), sum(mine), max(mine))
        for name, p in probs.items():
            assert r[name] == pytest.approx(np.quantile(mine, p))


def test_top_row_breaks_ties_by_smallest_key(spark):
    df = spark.createDataFrame([("a", 3, 9), ("a", 3, 4), ("a", 1, 1), ("b", 1, 2)],
                               "g string, n long, k long")
    rows = windows.top_row(df, "g", "n", "k").orderBy("g").collect()
    assert [tuple(r) for r in rows] == [("a", 3, 4), ("b", 1, 2)]


def test_split_rows_lose_nothing(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    met, rest = filters.split_rows(df, F.col("x") > 2)
    assert [r.x for r in met.collect()] == [3]
    assert Counter(r.x for r in rest.collect()) == Counter([1, None])


def test_empty_list_policies(spark):
    df = spark.range(3)
    assert filters.where_in(df, "id", []).count() == 0
    assert filters.where_in(df, "id", [], when_empty="all").count() == 3
    with pytest.raises(ValueError):
        filters.where_in(df, "id", [], when_empty="some")


def test_unmatched_counts_missing_codes(spark):
    codes = spark.createDataFrame([(1, "a")], CODES)
    df = spark.createDataFrame([(1,), (2,), (None,)], "c long")
    assert {r.c for r in joins.unmatched(df, codes, "c").collect()} == {2, None}


def test_duplicate_codes_are_found(spark):
    codes = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], CODES)
    assert [tuple(r) for r in gates.duplicate_keys(codes, "codigo").collect()] == [(1, 2)]
    with pytest.raises(gates.GateFailure, match="codigo"):
        gates.require_unique(codes, "codigo")
    assert gates.require_unique(codes, "descricao") is codes
