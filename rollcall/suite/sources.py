"""Scans, sinks, publication."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall import load, schemas
from rollcall.functions.text import nul_count, strip_nul
from rollcall.plans import changes, marts
from rollcall.session import scratch_path
from rollcall.sources import tables, text_files, zip_shards
from rollcall.suite.binding import AS_OF, Star
from rollcall.suite.registry import case

DAY = dt.date.fromisoformat(AS_OF)
_REG_TEXT = """SELECT entity_id, name, legal_nature, CAST(capital AS DOUBLE) AS capital,
    CAST(opened AS VARCHAR) AS opened, sector_code, muni_code, uf, status,
    CAST(status_date AS VARCHAR) AS status_date FROM reg"""


@case("scan_entity", "SELECT * FROM ent")
def _(s: Star) -> DataFrame:
    return text_files.read_entities(s.spark, s.raw_copy(s.ent, "entities"), split=True)


@case("scan_establishment", "SELECT * FROM est")
def _(s: Star) -> DataFrame:
    return text_files.read_establishments(s.spark, s.raw_copy(s.est, "establishments"), split=True)


@case("scan_entity_zip", "SELECT * FROM ent")
def _(s: Star) -> DataFrame:
    folder = s.zip_copy(s.ent, "Empresas")
    return zip_shards.read_entity_zips(s.spark, folder).drop(zip_shards.SHARD)


@case("scan_establishment_zip", "SELECT * FROM est")
def _(s: Star) -> DataFrame:
    folder = s.zip_copy(s.est, "Estabelecimentos")
    return zip_shards.read_establishment_zips(s.spark, folder).drop(zip_shards.SHARD)


@case("scan_reference", """
    SELECT CASE WHEN p_size = 1 THEN NULL ELSE p_partkey END AS codigo, p_type AS descricao
    FROM part""")
def _(s: Star) -> DataFrame:
    raw = s.table("part").select(
        F.when(F.col("p_size") == 1, F.lit("n/d"))
        .otherwise(F.col("p_partkey").cast("string"))
        .alias("codigo"),
        F.concat(F.lit("  "), "p_type", F.lit("\t ")).alias("descricao"),
    )
    path = s.raw_copy(raw, "codes")
    found = text_files.read_code_tables(s.spark, {"sectors": path, "absent": f"{path}-absent"})
    return found["sectors"]


@case("nul_clean", """
    SELECT o_orderkey AS id, c_name AS limpo,
           CAST(CASE WHEN c_acctbal < 0 THEN 2 ELSE 0 END AS BIGINT) AS removidos
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(s: Star) -> DataFrame:
    rows = s.table("orders").join(s.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    name, nul = F.col("c_name"), F.lit("\x00")
    dirty = F.when(
        F.col("c_acctbal") < 0,
        F.concat(F.substring(name, 1, 3), nul, F.substr(name, F.lit(4)), nul),
    ).otherwise(name)
    rows = rows.select(F.col("o_orderkey").alias("id"), dirty.alias("dirty"))
    return rows.select(
        "id", strip_nul(F.col("dirty")).alias("limpo"), nul_count(F.col("dirty")).alias("removidos")
    )


@case("nul_removed", """
    SELECT 2 * count(*) AS removed FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_acctbal < 0""")
def _(s: Star) -> DataFrame:
    rows = s.table("orders").join(s.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    nul = F.lit("\x00")
    dirty = F.when(F.col("c_acctbal") < 0, F.concat(nul, "c_name", nul)).otherwise(F.col("c_name"))
    return text_files.nul_removed(rows.select(dirty.alias("name"), "o_orderpriority"))


@case("shard_counts", """
    SELECT porte_empresa AS shard, count(*) AS rows,
           CAST(sum(count(*)) OVER (ORDER BY porte_empresa) AS BIGINT) AS running
    FROM ent GROUP BY porte_empresa""")
def _(s: Star) -> DataFrame:
    path = s.raw_copy(s.ent.withColumn("shard", F.col("porte_empresa")), "shards", "shard")
    return text_files.shard_counts(text_files.read_entities(s.spark, path), F.col("shard"))


@case("bronze_ready", """
    SELECT 'ent' AS tabela, count(*) > 0 AS pronta, count(*) AS linhas FROM ent UNION ALL
    SELECT 'est', count(*) > 0, count(*) FROM est""")
def _(s: Star) -> DataFrame:
    names = {n: s._name(f"bronze_{n}") for n in ("ent", "est")}
    tables.load_bronze(
        s.spark,
        {names["ent"]: lambda: s.ent, names["est"]: lambda: s.est},
        reuse=True,
    )
    ready = tables.bronze_ready(s.spark, *names.values())
    counts = tables.row_counts(s.spark, names.values())
    short = F.regexp_extract("tabela", r"^bronze_(\w{3})", 1)
    pronta = F.lit(ready) & (F.col("linhas") > 0)
    return counts.select(short.alias("tabela"), pronta.alias("pronta"), "linhas")


@case("publish_gold", _REG_TEXT)
def _(s: Star) -> DataFrame:
    return s.publish_gold()


_MART_COUNTS = " UNION ALL ".join(
    f"SELECT '{n}' AS tabela, count(*) AS linhas FROM {n}" for n in marts.MART_KEYS
)


def _mart_counts(s: Star, names: dict[str, str]) -> DataFrame:
    counts = tables.row_counts(s.spark, names.values())
    return counts.withColumn("tabela", F.regexp_replace("tabela", r"_[0-9a-f]{8}$", ""))


@case("refresh_marts", _MART_COUNTS)
def _(s: Star) -> DataFrame:
    return _mart_counts(s, s.refresh_marts())


@case("rebuild_dependents", _MART_COUNTS)
def _(s: Star) -> DataFrame:
    name = s._name("registry_rebuilt")
    keys = {n: f"{name}_{n}" for n in marts.MART_KEYS}

    def builders(gold: DataFrame) -> dict:
        return {keys[n]: build for n, build in s.builders(gold).items()}

    unique = {keys[n]: k for n, k in marts.MART_KEYS.items()}
    if failed := tables.publish_with_marts(s.reg, name, s.gates, builders, unique):
        raise RuntimeError(f"marts that could not be rebuilt: {failed}")
    counts = tables.row_counts(s.spark, keys.values())
    return counts.withColumn("tabela", F.regexp_extract("tabela", r"(mart_\w+)$", 1))


@case("publish_release", f"{_MART_COUNTS} UNION ALL SELECT 'registry_released', count(*) FROM reg")
def _(s: Star) -> DataFrame:
    """Gold and marts switched together, and read through the manifest."""
    name = s._name("registry_released")
    keys = {f"{name}_{n}": k for n, k in marts.MART_KEYS.items()}

    def builders(gold: DataFrame) -> dict:
        return {f"{name}_{n}": build for n, build in s.builders(gold).items()}

    tables.publish_release(
        s.spark, f"{name}_release", load.release_of_gold(name, s.reg, builders, keys),
        checks=load.release_checks(name, s.gates, keys), order={name: ("opened",)},
    )
    opened = tables.open_release(s.spark, f"{name}_release")
    parts = [
        rows.agg(F.count(F.lit(1)).alias("linhas")).select(
            F.lit("registry_released" if n == name else n.removeprefix(f"{name}_")).alias("tabela"), "linhas"
        )
        for n, rows in opened.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@case("changes_gold", _REG_TEXT)
def _(s: Star) -> DataFrame:
    """Gold of an earlier state with changes applied is the gold of today."""
    return s.changed()["gold"]


for _mart in marts.MART_KEYS:
    def _changed_mart(s: Star, mart: str = _mart) -> DataFrame:
        return s.changed()[mart]

    case(f"changes_{_mart}", f"SELECT * FROM {_mart}")(_changed_mart)


@case("changes_difference", """
    SELECT CAST(count(*) FILTER (WHERE opened >= DATE '1998-01-01' OR status_date >= DATE '1998-01-01') AS BIGINT)
               AS came,
           CAST(count(*) FILTER (WHERE opened < DATE '1998-01-01' AND status_date >= DATE '1998-01-01')
               + count(*) FILTER (WHERE opened < DATE '1998-01-01' AND uf = 'ASIA') AS BIGINT) AS went
    FROM reg""")
def _(s: Star) -> DataFrame:
    """What two whole versions differ by, both in buckets of the identifier."""
    layout = tables.Buckets("entity_id", s.buckets)
    was = tables.publish(s.earlier(), s._name("registry_was"), buckets=layout)
    now = tables.publish(s.reg, s._name("registry_now"), buckets=layout)
    sign = F.col(changes.SIGN)
    return changes.difference(was, now).agg(
        F.count_if(sign == 1).alias("came"), F.count_if(sign == -1).alias("went")
    )


@case("overwrite_table", "SELECT codigo, descricao FROM sec")
def _(s: Star) -> DataFrame:
    path = scratch_path(s.spark, "overwrite")
    tables.overwrite_table(s.mun, path)
    return tables.overwrite_table(s.sec, path)


@case("export_csv", """
    SELECT name AS razao_social, CAST(capital AS VARCHAR) AS capital_social,
           CAST(opened AS VARCHAR) AS data_abertura FROM reg""")
def _(s: Star) -> DataFrame:
    shown = s.reg.select(
        F.col("name").alias("razao_social"),
        F.col("capital").alias("capital_social"),
        F.col("opened").alias("data_abertura"),
    )
    path = text_files.export_csv(shown, scratch_path(s.spark, "export"), "empresas", DAY)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in shown.columns])
    return s.spark.read.schema(schema).options(sep=";", header=True).csv(path)


@case("read_mart", """
    SELECT setor, total, media, mediana, p05, q1, q3, p95 FROM mart_survival_sector""")
def _(s: Star) -> DataFrame:
    columns = "setor total media mediana p05 q1 q3 p95".split()
    return s.mart("mart_survival_sector", *columns)


_CONTRACT = T.StructType([
    T.StructField(f.name, T.StringType(), True)
    if f.name in ("legal_nature", "status")  # text in these tables
    else f
    for f in schemas.GOLD
])


@case("schema_contract", " UNION ALL ".join(
    f"SELECT '{f.name}' AS coluna, '{f.dataType.simpleString()}' AS tipo, "
    f"count({f.name}) AS preenchidas FROM reg" for f in _CONTRACT
))
def _(s: Star) -> DataFrame:
    reg = schemas.require(s.reg, _CONTRACT)
    filled = reg.agg(*[F.count(c).alias(c) for c in reg.columns])
    rows = [
        F.struct(
            F.lit(f.name).alias("coluna"),
            F.lit(f.dataType.simpleString()).alias("tipo"),
            F.col(f.name).alias("preenchidas"),
        )
        for f in reg.schema
    ]
    return filled.select(F.inline(F.array(*rows)))
