"""Reading raw extracts, typing, quarantine, gates, publication."""

import datetime as dt
import os
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rollcall import load, schemas
from rollcall.plans import gates, gold, marts
from rollcall.sources import tables, text_files, zip_shards

AS_OF = "2026-02-01"

ENTITIES = [
    '"123";"A ""X"" S";"2062";"49";"1234,50";"01";""',
    '"00000456";"Linha 1\nLinha 2; fim";"2135";"50";"";"05";""',
    '"789";"CafÉ";"";"50";;"05";""',
    '"999";"Sem loja";"2062";"50";"10,00";"05";""',
]
# Identifier, head-office flag, status, status date, opened, sector, state, municipality.
ESTABLISHMENTS = [
    ("123", "1", "02", "20100115", "20100115", "0111301", "SP", "7107"),
    ("123", "2", "02", "20100115", "20110115", "4711301", "SP", "7107"),
    ("456", "1", "08", "0", "20150630", "", "RJ", "6001"),
    ("789", "1", "", "20240230", "19990101", "4711301", "", ""),
    ("1001", "1", "02", "0", "00000000", "4711301", "SP", "7107"),
    ("1002", "1", "02", "0", "20990101", "4711301", "SP", "7107"),
    ("1003", "1", "02", "0", None, "4711301", "SP", "7107"),
    ("1004", "1", "02", "0", "0", "4711301", "SP", "7107"),
]


def establishment_line(row):
    given = dict(zip(
        ("cnpj_basico", "matriz_filial", "situacao_cadastral", "data_situacao",
         "data_inicio_atividade", "cnae_fiscal", "uf", "municipio"), row,
    ))
    fields = [given.get(n, "") for n in schemas.ESTABLISHMENT.fieldNames()]
    return ";".join("" if f is None else f'"{f}"' for f in fields)


@pytest.fixture
def folder(tmp_path):
    """Two entity shards and one establishment shard, as text and as zips, with stray NULs."""
    shards = {
        "Empresas0": "\n".join(ENTITIES[:2]) + "\n",
        "Empresas1": "\n".join(ENTITIES[2:]).replace("Sem", "S\x00em") + "\x00\n",
        "Estabelecimentos0": "\n".join(map(establishment_line, ESTABLISHMENTS)) + "\n",
    }
    (tmp_path / "zip").mkdir()
    for name, content in shards.items():
        kind = tmp_path / name.rstrip("01")
        kind.mkdir(exist_ok=True)
        (kind / f"{name}.csv").write_bytes(content.encode("latin-1"))
        with zipfile.ZipFile(tmp_path / "zip" / f"{name}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(f"{name}.CSV", content.encode("latin-1"))
    return str(tmp_path)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def test_quotes_breaks_encoding_and_nulls(spark, folder):
    df = text_files.read_entities(spark, f"{folder}/Empresas")
    rows = {r["cnpj_basico"]: r for r in df.collect()}
    assert len(rows) == 4
    assert rows["123"]["razao_social"] == 'A "X" S'
    assert rows["00000456"]["razao_social"] == "Linha 1\nLinha 2; fim"
    assert rows["789"]["razao_social"] == "CafÉ"
    assert rows["999"]["razao_social"] == "Sem loja"
    # Quoted empty text is not a missing value; an unquoted empty field is.
    assert rows["00000456"]["capital_social"] == ""
    assert rows["789"]["capital_social"] is None


def test_zip_source_reads_the_same_rows(spark, folder):
    from_text = text_files.read_entities(spark, f"{folder}/Empresas")
    from_zip = zip_shards.read_entity_zips(spark, f"{folder}/zip")
    names = schemas.ENTITY.fieldNames()
    # Zips lose their NULs before parsing, so even one beside a quote does no harm.
    assert rows_of(from_zip, *names) == rows_of(from_text, *names)
    assert from_zip.rdd.getNumPartitions() == 2
    est = zip_shards.read_establishment_zips(spark, f"{folder}/zip")
    from_text = text_files.read_establishments(spark, f"{folder}/Estabelecimentos")
    names = schemas.ESTABLISHMENT.fieldNames()
    assert rows_of(est, *names) == rows_of(from_text, *names)


def test_zip_source_needs_a_match(spark, folder):
    with pytest.raises(Exception, match="no file matches"):
        zip_shards.read_entity_zips(spark, folder, "Nada*.zip").count()


def test_zip_source_streams_small_blocks(folder):
    path = f"{folder}/zip/Empresas0.zip"
    columns = schemas.ENTITY.fieldNames()
    batches = list(zip_shards.shard_batches(path, columns, block=128))
    assert sum(b.num_rows for b in batches) == 2


def test_a_record_of_the_wrong_length_stops_the_load(spark, tmp_path):
    lines = "\n".join([*ENTITIES, '"1";"too short"']) + "\n"
    (tmp_path / "bad.csv").write_bytes(lines.encode("latin-1"))
    with pytest.raises(Exception, match="(?i)malformed"):
        text_files.read_entities(spark, str(tmp_path / "bad.csv")).collect()
    lenient = text_files.read_entities(spark, str(tmp_path / "bad.csv"), mode="PERMISSIVE")
    assert lenient.count() == 5
    with zipfile.ZipFile(tmp_path / "Empresas0.zip", "w") as z:
        z.writestr("bad.csv", lines.encode("latin-1"))
    with pytest.raises(Exception, match="Expected 7 columns"):
        zip_shards.read_entity_zips(spark, str(tmp_path)).collect()


def test_nul_report_and_count(spark, folder):
    report = dict(rows_of(zip_shards.zip_nul_report(spark, f"{folder}/zip", "Empresas*.zip")))
    assert report == {"Empresas0.zip": 0, "Empresas1.zip": 2}
    raw = text_files.read_raw(spark, f"{folder}/Empresas", schemas.ENTITY)
    assert text_files.nul_removed(raw).first()["removed"] >= 1


def test_blocks_of_nul_alone_and_long_records(spark, tmp_path):
    long = "z" * 5000
    body = f'"1";"a{chr(0) * 3000}b";;;"1,00";;\n"2";"{long}";;;;;\n'.encode("latin-1")
    with zipfile.ZipFile(tmp_path / "Empresas0.zip", "w") as z:
        z.writestr("x.csv", body)
    read = zip_shards.read_entity_zips(spark, str(tmp_path), block=9000)
    assert rows_of(read.select("cnpj_basico", "razao_social")) == [("1", "ab"), ("2", long)]
    assert zip_shards.shard_nuls(str(tmp_path / "Empresas0.zip"), 64) == 3000
    with pytest.raises(Exception, match="(?i)straddling|block"):
        zip_shards.read_entity_zips(spark, str(tmp_path), block=1000).collect()


def test_shard_counts(spark, folder):
    zips = zip_shards.read_entity_zips(spark, f"{folder}/zip")
    assert rows_of(text_files.shard_counts(zips, F.col("shard"))) == [
        ("Empresas0.zip", 2, 2), ("Empresas1.zip", 2, 4),
    ]
    raw = text_files.read_raw(spark, f"{folder}/Empresas", schemas.ENTITY)
    assert rows_of(text_files.shard_counts(raw)) == [
        ("Empresas0.csv", 2, 2), ("Empresas1.csv", 2, 4),
    ]


def test_code_tables_skip_the_missing(spark, tmp_path):
    (tmp_path / "cnae.csv").write_bytes('"0111301";" CafÉ "\n"x";"sem código"\n"47";\n'.encode("latin-1"))
    found = text_files.read_code_tables(
        spark, {"sectors": f"{tmp_path}/cnae.csv", "munis": f"{tmp_path}/none.csv"}
    )
    assert list(found) == ["sectors"]
    assert rows_of(found["sectors"]) == [
        (111301, "CafÉ"), (47, None), (None, "sem código"),
    ]
    assert schemas.contract_breaks(found["sectors"], schemas.CODES) == []


@pytest.fixture
def built(spark, folder):
    ent = text_files.read_entities(spark, f"{folder}/Empresas")
    est = text_files.read_establishments(spark, f"{folder}/Estabelecimentos")
    return ent, est, gold.build_gold(ent, est, AS_OF)


def test_gold_rows(built):
    _, _, df = built
    assert schemas.contract_breaks(df, schemas.GOLD) == []
    assert rows_of(df) == [
        ("00000123", 'A "X" S', 2062, Decimal("1234.50"), dt.date(2010, 1, 15), 111301, 7107,
         "SP", 2, dt.date(2010, 1, 15)),
        ("00000456", "Linha 1\nLinha 2; fim", 2135, Decimal("0.00"), dt.date(2015, 6, 30), None,
         6001, "RJ", 8, None),
        ("00000789", "CafÉ", None, Decimal("0.00"), dt.date(1999, 1, 1), 4711301, None,
         "", None, None),
    ]


def test_quarantine_holds_every_other_head_office(built):
    _, est, df = built
    assert gold.quarantine_count(est, AS_OF).first()["quarantined"] == 4
    valid, set_aside = gold.split_quarantine(est, AS_OF)
    assert valid.count() + set_aside.count() == gold.head_offices(est).count() == 7
    assert {r[0] for r in rows_of(set_aside, "cnpj_basico")} == {"1001", "1002", "1003", "1004"}


def test_duplicate_head_offices_multiply_and_are_caught(spark, built):
    ent, est, _ = built
    twice = est.unionByName(est.where(F.col("cnpj_basico") == "123"))
    df = gold.build_gold(ent, twice, AS_OF)
    report = {r.gate: r for r in gates.run_gates(df, ent, min_rows=0, as_of=AS_OF).collect()}
    assert report["unique"].value == 1.0 and not report["unique"].passed


def test_gates_pass_and_fail(spark, built):
    ent, _, df = built
    report = {r.gate: r for r in gates.run_gates(df, ent, min_rows=2, as_of=AS_OF).collect()}
    assert list(report) == list(gates.GATES)
    assert report["volume"].value == 3.0 and report["volume"].passed
    assert report["retention"].value == 75.0 and not report["retention"].passed
    assert report["unique"].passed and report["complete"].passed and report["domain"].passed
    # Two of three opened in the 2010s.
    assert report["distribution"].value == 66.7 and not report["distribution"].passed
    with pytest.raises(gates.GateFailure) as caught:
        gates.enforce(gates.run_gates(df, ent, as_of=AS_OF))
    assert caught.value.failed == ["volume", "retention", "distribution"]


def test_gates_on_nothing_do_not_pass(spark, built):
    ent, _, df = built
    none = df.where(F.lit(False))
    report = {r.gate: r for r in gates.run_gates(none, ent.where(F.lit(False))).collect()}
    assert report["retention"].value is None and not report["retention"].passed
    assert report["distribution"].value is None and not report["distribution"].passed
    assert not report["volume"].passed and report["unique"].passed


def test_dates_gates(spark):
    df = spark.createDataFrame(
        [("1", dt.date(1899, 12, 31)), ("2", dt.date(2027, 1, 1)), ("3", None),
         ("4", dt.date(2000, 1, 1))], "entity_id string, opened date",
    )
    report = {r.gate: r for r in gates.run_gates(df, df, min_rows=3, as_of=AS_OF).collect()}
    assert report["complete"].value == 1.0 and report["domain"].value == 2.0


def test_failed_gate_keeps_the_published_version(spark, built):
    ent, _, df = built

    def strict(rows):
        return gates.run_gates(rows, ent, min_rows=0, min_retention=70, max_decade_share=70,
                               as_of=AS_OF)

    first = tables.publish(df, "gold_t1", strict)
    assert first.count() == 3
    [first_version] = tables.versions(spark, "gold_t1")
    worse = df.where(F.col("entity_id") == "00000123")
    with pytest.raises(gates.GateFailure):
        tables.publish(worse, "gold_t1", strict)
    assert spark.table("gold_t1").count() == 3
    assert tables.versions(spark, "gold_t1") == [first_version]  # the failed one is gone


def test_only_the_last_versions_are_kept(spark):
    for n in range(1, 5):
        tables.publish(spark.range(n).withColumn("opened", F.lit(n)), "kept_t", keep=2)
        assert spark.table("kept_t").count() == n
        assert len(tables.versions(spark, "kept_t")) == min(n, 2)
    tables.publish(spark.range(9).withColumn("opened", F.lit(1)), "kept_t", keep=1)
    assert len(tables.versions(spark, "kept_t")) == 1 and spark.table("kept_t").count() == 9


def test_mart_with_duplicate_keys_keeps_its_old_version(spark):
    good = spark.createDataFrame([("a", 1), ("b", 2)], "uf string, n int")
    assert tables.refresh_marts(spark, {"mart_k": lambda: good}, keys={"mart_k": ["uf"]}) == []
    twice = good.unionByName(good)
    assert tables.refresh_marts(spark, {"mart_k": lambda: twice}, keys={"mart_k": ["uf"]}) == ["mart_k"]
    assert spark.table("mart_k").count() == 2 and len(tables.versions(spark, "mart_k")) == 1


def test_codes_listed_twice_stop_the_load(spark, tmp_path):
    (tmp_path / "cnae.csv").write_bytes(b'"47";"a"\n"47";"b"\n"x";"c"\n"y";"d"\n')
    with pytest.raises(gates.GateFailure, match="codigo"):
        text_files.read_code_tables(spark, {"sectors": f"{tmp_path}/cnae.csv"})


def test_load_as_one_call(spark, built, folder):
    ent, est, df = built
    sources = {"one_ent": lambda: ent, "one_est": lambda: est}
    sec = spark.createDataFrame([(111301, "x"), (4711301, "y")], schemas.CODES)
    mun = spark.createDataFrame([(7107, "z")], schemas.CODES)
    lenient = dict(min_rows=0, min_retention=70, max_decade_share=70)
    for _ in range(3):
        failed = load.run_load(
            spark, sources, sec, mun, prefix="one_", as_of=AS_OF, keep=2, min_sector=1, **lenient
        )
        assert failed == []
    assert spark.table("one_gold").count() == df.count()
    assert spark.table("one_quarantine").count() == 4
    reasons = dict(rows_of(spark.table("one_quarantine_reasons")))
    assert sum(n for r, n in reasons.items() if r.startswith("abertura")) == 4
    assert spark.table("one_mart_density_uf").count() == 3
    assert all(len(tables.versions(spark, t)) == 2 for t in ("one_gold", "one_quarantine", "one_mart_bubbles"))
    with pytest.raises(gates.GateFailure):
        load.run_load(spark, sources, sec, mun, prefix="one_", as_of=AS_OF, min_rows=99)
    assert spark.table("one_gold").count() == df.count() and len(tables.versions(spark, "one_gold")) == 2


def test_a_load_with_sums_slice_and_buckets_takes_changes(spark, built, folder):
    ent, est, df = built
    sec = spark.createDataFrame([(111301, "x"), (4711301, "y")], schemas.CODES)
    mun = spark.createDataFrame([(7107, "z")], schemas.CODES)
    sources = {"six_ent": lambda: ent, "six_est": lambda: est}
    settings = dict(prefix="six_", as_of=AS_OF, min_sector=1, min_rows=0, min_retention=0, max_decade_share=101)
    assert load.run_load(spark, sources, sec, mun, sums=True, top=True, buckets=3, **settings) == []
    assert rows_of(spark.table("six_gold")) == rows_of(df)
    assert rows_of(spark.table("six_mart_region_kpis")) == rows_of(marts.region_kpis(df))
    largest = spark.table("six_top_capital").first()
    assert largest.capital == df.agg(F.max("capital")).first()[0]
    richer = df.where(F.col("entity_id") == "00000456").withColumn("capital", F.lit(10**6).cast("decimal(18,2)"))
    gone = df.where(F.col("entity_id") == "00000123").select("entity_id")
    assert load.run_changes(spark, richer, sec, mun, gone=gone, buckets=3, **settings)
    after = df.where(~F.col("entity_id").isin("00000123", "00000456")).unionByName(richer)
    opened = tables.open_release(spark, "six_release")
    assert rows_of(opened["six_gold"]) == rows_of(after)
    assert rows_of(opened["six_mart_region_kpis"]) == rows_of(marts.region_kpis(after))
    assert rows_of(opened["six_top_capital"], "entity_id") == [("00000456",)]
    assert opened["six_quarantine"].count() == 4
    with pytest.raises(ValueError, match="release only"):
        load.run_load(spark, sources, sec, mun, sums=True, together=False, **settings)


def test_a_release_switches_all_tables_at_once(spark, built):
    _, _, df = built

    def release(tag, mart=None, gate=None, rows=df):
        return tables.publish_release(
            spark, "t3_release",
            {"t3_gold": lambda _: rows.withColumn("load", F.lit(tag)),
             "t3_mart": mart or (lambda read: read("t3_gold").groupBy("uf", "load").count())},
            checks={"t3_gold": gate or (lambda rows: None),
                    "t3_mart": lambda rows: gates.require_unique(rows, "uf")},
            order={"t3_gold": ("opened",)},
        )

    def seen():
        opened = tables.open_release(spark, "t3_release")
        by_view = [{r.load for r in spark.table(t).select("load").collect()} for t in ("t3_gold", "t3_mart")]
        by_release = [{r.load for r in opened[t].select("load").collect()} for t in ("t3_gold", "t3_mart")]
        return by_release, by_view

    def fail(rows):
        raise gates.GateFailure(["volume"])

    release("one")
    held = tables.open_release(spark, "t3_release")
    assert seen() == ([{"one"}] * 2, [{"one"}] * 2)
    with pytest.raises(gates.GateFailure):
        release("two", gate=fail)
    with pytest.raises(Exception, match="no_such_column"):
        release("three", mart=lambda read: read("t3_gold").select("no_such_column"))
    with pytest.raises(gates.GateFailure):
        release("four", mart=lambda read: read("t3_gold").select("uf", "load").limit(1).union(
            read("t3_gold").select("uf", "load").limit(1)))
    assert seen() == ([{"one"}] * 2, [{"one"}] * 2)
    assert len(tables.versions(spark, "t3_gold")) == len(tables.versions(spark, "t3_mart")) == 1
    release("five")
    assert seen() == ([{"five"}] * 2, [{"five"}] * 2)
    assert {r.load for r in held["t3_mart"].collect()} == {"one"}  # a reader that came before the switch


def test_a_mart_that_fails_keeps_the_whole_load_back(spark, built, folder, monkeypatch):
    ent, est, df = built
    sec = spark.createDataFrame([(111301, "x"), (4711301, "y")], schemas.CODES)
    mun = spark.createDataFrame([(7107, "z")], schemas.CODES)
    sources = {"two_ent": lambda: ent, "two_est": lambda: est}
    lenient = dict(min_rows=0, min_retention=0, max_decade_share=101)
    settings = dict(prefix="two_", as_of=AS_OF, min_sector=1, **lenient)
    assert load.run_load(spark, sources, sec, mun, **settings) == []
    before = {r.name: r.version for r in spark.table("two_release").collect()}
    assert set(before) == {f"two_{n}" for n in ("gold", "quarantine", "quarantine_reasons", *marts.MART_KEYS)}
    usual = marts.mart_builders

    def broken(*args, **options):
        return usual(*args, **options) | {"mart_treemap": lambda: args[0].select("no_such_column")}

    monkeypatch.setattr(marts, "mart_builders", broken)
    with pytest.raises(Exception, match="no_such_column"):
        load.run_load(spark, sources, sec, mun, **settings)
    assert {r.name: r.version for r in spark.table("two_release").collect()} == before
    assert all(len(tables.versions(spark, n)) == 1 for n in before)
    assert load.run_load(spark, sources, sec, mun, together=False, **settings) == ["two_mart_treemap"]


def test_reasons_of_what_is_set_aside(spark):
    est = spark.createDataFrame(
        [("1", d, "1") for d in (None, "", "abc", "20250230", "18991231", "20990101", "20000101")]
        + [("2", "x", "2"), ("123456789", "20000101", "1")],
        "cnpj_basico string, data_inicio_atividade string, matriz_filial string",
    )
    ent = spark.createDataFrame([("1", "1.000,00"), ("2", ""), ("123456789", "9,9")],
                                "cnpj_basico string, capital_social string")
    assert rows_of(gold.quarantine_reasons(ent, est, AS_OF)) == [
        ("abertura_ausente", 2), ("abertura_fora_do_intervalo", 2), ("abertura_invalida", 2),
        ("capital_ilegivel", 1), ("identificador_longo", 1),
    ]


def test_marts_fail_alone(spark, built):
    _, _, df = built
    builders = {
        "mart_a": lambda: df.groupBy("uf").count(),
        "mart_b": lambda: df.select("no_such_column"),
        "mart_c": lambda: df.groupBy("status").count(),
    }
    assert tables.refresh_marts(spark, builders) == ["mart_b"]
    assert tables.read_mart(spark, "mart_a", "uf").count() == 3
    assert tables.read_mart(spark, "mart_c").count() == 3
    assert not spark.catalog.tableExists("mart_b")
    assert tables.refresh_marts(spark, builders, ["mart_a"]) == []
    assert rows_of(tables.row_counts(spark, ["mart_a", "mart_c"])) == [("mart_a", 3), ("mart_c", 3)]


def test_bronze_is_reused_only_when_filled(spark, built):
    ent, est, _ = built
    assert not tables.bronze_ready(spark, "bz_ent", "bz_est")
    sources = {"bz_ent": lambda: ent, "bz_est": lambda: est}
    landed = tables.load_bronze(spark, sources)
    assert landed["bz_ent"].count() == 4
    assert tables.bronze_ready(spark, "bz_ent", "bz_est")

    def unread():
        raise AssertionError("bronze was read again")

    tables.load_bronze(spark, {"bz_ent": unread, "bz_est": unread}, reuse=True)
    tables.load_bronze(spark, {"bz_ent": lambda: ent.where(F.lit(False))})
    assert not tables.bronze_ready(spark, "bz_ent", "bz_est")


def test_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_table(spark.range(5), path)
    assert tables.overwrite_table(spark.range(2), path).count() == 2


def test_export_has_mark_separator_and_date(spark, tmp_path):
    df = spark.createDataFrame([("São Paulo", 1.5), ("a;b", None)], "nome string, valor double")
    path = text_files.export_csv(df, str(tmp_path), "comparador", dt.date(2026, 2, 1))
    assert path.endswith("/comparador_20260201")
    parts = [f for f in os.listdir(path) if f.endswith(".csv")]
    contents = [open(f"{path}/{p}", "rb").read() for p in parts]
    assert all(c.startswith(b"\xef\xbb\xbfnome;valor\n") for c in contents)
    lines = sorted(line for c in contents for line in c.decode("utf-8-sig").splitlines()[1:])
    assert lines == ['"a;b";', "São Paulo;1.5"]


def test_contract(spark, built):
    _, _, df = built
    assert schemas.require(df, schemas.GOLD) is df
    breaks = schemas.contract_breaks(
        df.drop("uf").withColumn("status", F.lit("2")), schemas.GOLD
    )
    assert breaks == ["uf: missing", "status: string instead of int"]
    with pytest.raises(schemas.ContractError):
        schemas.require(df.drop("uf"), schemas.GOLD)


def test_published_names_round_trip(built):
    _, _, df = built
    published = schemas.to_published(df)
    assert "cnpj_basico" in published.columns and "razao_social" in published.columns
    assert schemas.to_roles(published).columns == df.columns
