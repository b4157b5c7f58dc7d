"""The benchmark tables seen as a company registry.

An order is an entity, its customer gives name, capital, municipality (nation and segment) in a state
(region), segment and priority its nature; its lines give sector (part) and closing date. A line is also an establishment of the raw
layout, line number 1 being the head office. The same views are written once as DataFrames and once
as SQL for the checking engine.
"""

from __future__ import annotations

import hashlib
import re
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall import load
from rollcall.functions.text import pad_id
from rollcall.plans import gates, marts
from rollcall.plans.gold import build_gold
from rollcall.schemas import ENTITY, ESTABLISHMENT
from rollcall.session import scratch_path, ship_package, stage
from rollcall.sources import tables, text_files, zip_shards

# Parameters of the binding: reference date, status values, thresholds suited to these tables.
AS_OF = "2002-01-01"
CLOSED, ACTIVE = "F", "O"
MIN_SECTOR = 30
SINCE = "1997-01-01"
BEFORE = "1998-01-01"
MIN_ROWS = 1_000
MAX_DECADE = 95.0
DUE_UFS = ["ASIA", "EUROPE", "AFRICA"]
PREFIXES = ["11", "12", "21", "23"]
MUNIS = [31, 72, 153]
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

_gold: dict[tuple, str] = {}
_marts: dict[tuple, dict[str, str]] = {}
_etl: dict[tuple, DataFrame] = {}
_changed: dict[tuple, str] = {}
_schemas: dict[tuple[str, str], T.StructType] = {}


class Star:
    """Registry views over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        """A given table; its schema is read from a footer once, not by a job per query."""
        path = f"{self.folder}/{name}.parquet"
        if (self.folder, name) not in _schemas:
            _schemas[self.folder, name] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[self.folder, name]).parquet(path)

    @cached_property
    def reg(self) -> DataFrame:
        lines = self.table("lineitem").groupBy("l_orderkey").agg(
            F.min("l_partkey").alias("sector_code"),
            F.max("l_shipdate").cast("date").alias("status_date"),
        )
        joined = (
            self.table("orders")
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        )
        return joined.select(
            pad_id(F.col("o_orderkey").cast("string")).alias("entity_id"),
            F.col("c_name").alias("name"),
            F.concat_ws("-", "c_mktsegment", F.substring("o_orderpriority", 1, 1)).alias("legal_nature"),
            F.greatest("c_acctbal", F.lit(0.0)).cast("decimal(18,2)").alias("capital"),
            F.col("o_orderdate").cast("date").alias("opened"),
            "sector_code",
            (F.col("c_nationkey") * 10 + _segment(F.col("c_mktsegment"))).alias("muni_code"),
            F.col("r_name").alias("uf"),
            F.col("o_orderstatus").alias("status"),
            "status_date",
        )

    @cached_property
    def sec(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("codigo"), F.concat_ws(" ", "p_type", "p_brand").alias("descricao")
        )

    @cached_property
    def mun(self) -> DataFrame:
        each = F.explode(F.array(*map(F.lit, SEGMENTS))).alias("segment")
        return self.table("nation").select("n_nationkey", "n_name", each).select(
            (F.col("n_nationkey") * 10 + _segment(F.col("segment"))).alias("codigo"),
            F.concat_ws(" ", "n_name", "segment").alias("descricao"),
        )

    @cached_property
    def nat(self) -> DataFrame:
        priority = F.explode(F.array(*[F.lit(str(n)) for n in range(1, 6)]))
        kinds = self.table("customer").select("c_mktsegment").distinct().withColumn("p", priority)
        return kinds.select(F.concat_ws("-", "c_mktsegment", "p").alias("codigo")).withColumn(
            "descricao", F.concat(F.lit("Natureza "), F.col("codigo"))
        )

    @cached_property
    def ent(self) -> DataFrame:
        """Raw entity layout: seven text columns."""
        capital = F.greatest("c_acctbal", F.lit(0.0)).cast("decimal(18,2)").cast("string")
        dirty = F.col("o_orderkey") % 101
        given = {
            "cnpj_basico": _raw_id("o_orderkey"),
            "razao_social": F.col("c_name"),
            "natureza_juridica": F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(
                F.col("c_nationkey").cast("string")
            ),
            "capital_social": F.when(dirty == 1, F.lit("1.234,56"))
            .when(dirty == 2, F.lit("20000000000000000,00"))
            .when(dirty == 3, F.lit("n/d"))
            .when(dirty == 4, F.lit(""))
            .otherwise(F.translate(capital, ".", ",")),
            "porte_empresa": F.col("o_orderpriority"),
        }
        rows = self.table("orders").join(
            self.table("customer"), F.col("o_custkey") == F.col("c_custkey")
        )
        return rows.select(*_layout(ENTITY, given))

    @cached_property
    def est(self) -> DataFrame:
        """Raw establishment layout: thirty text columns, dates and codes as dirty as found."""
        part, shipped = F.col("l_partkey"), F.date_format("l_shipdate", "yyyyMMdd")
        closed = F.col("l_linestatus") == "F"
        given = {
            "cnpj_basico": _raw_id("l_orderkey"),
            "cnpj_ordem": F.lpad(F.col("l_linenumber").cast("string"), 4, "0"),
            "cnpj_dv": F.lit("00"),
            "matriz_filial": F.col("l_linenumber").cast("string"),
            "nome_fantasia": F.concat(
                F.lit('É "'), F.col("l_returnflag"), F.lit('";\n'), F.col("l_linestatus")
            ),
            "situacao_cadastral": F.when(F.col("l_discount") == 0, F.lit(""))
            .when(closed, F.lit("08"))
            .otherwise(F.lit("02")),
            "data_situacao": F.when(closed, shipped).otherwise(F.lit("0")),
            "data_inicio_atividade": F.when(part % 97 == 0, F.lit("00000000"))
            .when(part % 89 == 0, F.lit("20991231"))
            .when(part % 83 == 0, F.lit(""))
            .when(part % 79 == 0, F.lit(None).cast("string"))
            .otherwise(shipped),
            "cnae_fiscal": F.when(part % 53 == 0, F.lit("")).otherwise(part.cast("string")),
            "uf": F.col("l_returnflag"),
            "municipio": F.col("l_suppkey").cast("string"),
            "correio_eletronico": F.lit(""),
        }
        return self.table("lineitem").select(*_layout(ESTABLISHMENT, given))

    # --- tables written once per session, as a nightly load would ------------------------------

    @property
    def _key(self) -> tuple:
        return self.spark.sparkContext.applicationId, self.folder

    def _name(self, stem: str) -> str:
        return f"{stem}_{hashlib.md5(self.folder.encode()).hexdigest()[:8]}"

    def etl_gold(self) -> DataFrame:
        """Gold built from the raw layout, written once: gates read what was written."""
        if self._key not in _etl:
            _etl[self._key] = stage(build_gold(self.ent, self.est, AS_OF), "etl-gold")
        return _etl[self._key]

    def gates(self, gold: DataFrame) -> DataFrame:
        return gates.run_gates(
            gold,
            self.table("orders"),
            min_rows=MIN_ROWS,
            max_decade_share=MAX_DECADE,
            as_of=AS_OF,
        )

    def publish_gold(self) -> DataFrame:
        name = self._name("registry_gold")
        published = tables.publish(self.reg, name, self.gates)
        _gold[self._key] = name
        return published

    def builders(self, gold: DataFrame) -> dict:
        return marts.mart_builders(
            gold,
            self.sec,
            self.mun,
            closed=CLOSED,
            active=ACTIVE,
            min_sector=MIN_SECTOR,
            since=SINCE,
        )

    def refresh_marts(self) -> dict[str, str]:
        """Rebuild all marts from published gold; their table names by mart name."""
        if self._key not in _gold:
            self.publish_gold()
        gold = self.spark.table(_gold[self._key])
        named = {self._name(n): build for n, build in self.builders(gold).items()}
        keys = {self._name(n): k for n, k in marts.MART_KEYS.items()}
        if failed := tables.refresh_marts(self.spark, named, keys=keys):
            raise RuntimeError(f"marts that could not be rebuilt: {failed}")
        return {n: self._name(n) for n in self.builders(gold)}

    def mart(self, name: str, *columns: str) -> DataFrame:
        """A mart as stored; the first reader of a session has all marts built."""
        if self._key not in _marts:
            _marts[self._key] = self.refresh_marts()
        return tables.read_mart(self.spark, _marts[self._key][name], *columns)

    @property
    def buckets(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def etl_gold_in_buckets(self) -> DataFrame:
        """Gold from the raw layout, published in buckets of its identifier."""
        return tables.publish(
            build_gold(self.ent, self.est, AS_OF, self.buckets),
            self._name("registry_buckets"),
            buckets=tables.Buckets("entity_id", self.buckets, spread=False),
        )

    def earlier(self, reg: DataFrame | None = None) -> DataFrame:
        """The registry as it was: later openings missing, later closings open, and some entities gone since."""
        reg = self.reg if reg is None else reg
        later = F.coalesce(F.col("status_date") >= F.lit(BEFORE).cast("date"), F.lit(False))
        was = reg.where(F.col("opened") < F.lit(BEFORE).cast("date")).withColumns({
            "status": F.when(later, F.lit(ACTIVE)).otherwise(F.col("status")),
            "status_date": F.when(~later, F.col("status_date")),
        })
        marks = F.when(F.col("uf") == "ASIA", F.array(F.lit(""), F.lit("x"))).otherwise(F.array(F.lit("")))
        marked = was.withColumn("mark", F.explode(marks))
        return marked.withColumn("entity_id", F.concat("mark", "entity_id")).drop("mark")

    def changed(self) -> dict[str, DataFrame]:
        """Tables of the release that changes have made of an earlier registry, once per session."""
        settings = dict(closed=CLOSED, active=ACTIVE, since=SINCE)
        prefix = _changed.get(self._key)
        if prefix is None:
            prefix = f"{self._name('changed')}_"
            keys = {f"{prefix}{n}": k for n, k in marts.MART_KEYS.items()}
            # Joined once; the earlier state and what has changed since are cut from it row by row.
            name, reg = f"{prefix}gold", stage(self.reg, "registry")
            earlier = self.earlier(reg)

            def builders(gold: DataFrame, stored: tuple[DataFrame, DataFrame]) -> dict:
                built = marts.mart_builders(
                    gold, self.sec, self.mun, min_sector=MIN_SECTOR, stored=stored, **settings
                )
                return {f"{prefix}{n}": build for n, build in built.items()}

            tables.publish_release(
                self.spark, f"{prefix}release",
                load.release_of_gold(
                    name, earlier, builders, keys, load.release_of_sums(prefix, CLOSED, ACTIVE, SINCE)
                ),
                order={name: ("opened",)},
                buckets={name: tables.Buckets("entity_id", self.buckets)},
            )
            day = F.lit(BEFORE).cast("date")
            rows = reg.where((F.col("opened") >= day) | (F.col("status_date") >= day))
            kept = load.run_changes(
                self.spark, rows, self.sec, self.mun, prefix=prefix, as_of=AS_OF,
                gone=earlier.where(F.col("entity_id").startswith("x")), min_sector=MIN_SECTOR,
                min_rows=MIN_ROWS, min_retention=50, max_decade_share=MAX_DECADE,
                buckets=self.buckets, **settings,
            )
            if not kept:
                raise RuntimeError("sums were made anew")
            _changed[self._key] = prefix
        opened = tables.open_release(self.spark, f"{prefix}release")
        return {n.removeprefix(prefix): df for n, df in opened.items()}

    def raw_copy(self, df: DataFrame, stem: str, *partitions: str) -> str:
        """The frame written in the raw text layout below the shared folder."""
        path = scratch_path(self.spark, stem)
        text_files.write_raw(df, path, *partitions)
        return path

    def zip_copy(self, df: DataFrame, stem: str) -> str:
        """The frame written as zipped shards below the shared folder, which must be mounted."""
        ship_package(self.spark)
        folder = scratch_path(self.spark, stem.lower()).removeprefix("file:")
        zip_shards.write_zips(df, folder, stem)
        return folder


def _segment(name: Column) -> Column:
    """Number of a market segment, from 1."""
    return F.array_position(F.array(*map(F.lit, SEGMENTS)), name)


def _raw_id(key: str) -> Column:
    """An order's identifier in the extracts; some have a digit more than the usual eight."""
    long = F.col(key) + 100_000_000
    return F.when(F.col(key) % 53 == 0, long).otherwise(F.col(key)).cast("string")


def _layout(schema: T.StructType, given: dict) -> list:
    return [given.get(n, F.lit(None).cast("string")).alias(n) for n in schema.fieldNames()]


def portable(df: DataFrame) -> DataFrame:
    """Result types both engines share: bigint, double, text, boolean; dates as ISO text."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


# --- the same views as SQL ----------------------------------------------------------------------


def ratio(num: str, den: str, decimals: int) -> str:
    """Exact half-up rounding of a ratio of whole numbers that are not negative."""
    scale = 10**decimals
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return f"CAST(({n} * {2 * scale} + {d}) // nullif(2 * {d}, 0) AS DOUBLE) / {scale}"


def percent(num: str, den: str, decimals: int) -> str:
    return ratio(f"100 * ({num})", den, decimals)


def money_mean(total: str, count: str) -> str:
    return ratio(f"({total}) * 100", f"100 * ({count})", 2)


def mean_years(total_days: str, count: str, decimals: int) -> str:
    return ratio(f"4 * ({total_days})", f"1461 * ({count})", decimals)


def _sql_layout(schema: T.StructType, given: dict[str, str]) -> str:
    return ", ".join(
        f"{given.get(n, 'CAST(NULL AS VARCHAR)')} AS {n}" for n in schema.fieldNames()
    )


_capital = "CAST(greatest(c_acctbal, 0) AS DECIMAL(18,2))"
_shipped = "strftime(l_shipdate, '%Y%m%d')"
_compact = "CAST(try_strptime({0}, '%Y%m%d') AS DATE)"
_valid_opening = (
    "coalesce(regexp_full_match(data_inicio_atividade, '[0-9]{8}') AND "
    + _compact.format("data_inicio_atividade")
    + f" BETWEEN DATE '1900-01-01' AND DATE '{AS_OF}', false)"
)
VALID_OPENING = _valid_opening
# An amount has up to two decimals; blank counts as 0, all else as NULL.
AMOUNT_SQL = """CASE WHEN trim(coalesce(capital_social, '')) = '' THEN 0
    WHEN regexp_full_match(trim(capital_social), '-?[0-9]+([,.][0-9][0-9]?)?')
        THEN TRY_CAST(replace(capital_social, ',', '.') AS DECIMAL(18,2)) END"""
_points = ", ".join(
    f"round(quantile_cont(CAST(days AS DOUBLE), {p}) / 365.25, 2) AS {n}"
    for n, p in marts.SECTOR_POINTS.items()
)



def _raw_id_sql(key: str) -> str:
    return f"CAST(CASE WHEN {key} % 53 = 0 THEN {key} + 100000000 ELSE {key} END AS VARCHAR)"


VIEWS = {
    "reg": f"""
        SELECT CASE WHEN o_orderkey < 10000000 THEN lpad(CAST(o_orderkey AS VARCHAR), 8, '0')
                    ELSE CAST(o_orderkey AS VARCHAR) END AS entity_id, c_name AS name,
               c_mktsegment || '-' || left(o_orderpriority, 1) AS legal_nature, {_capital} AS capital,
               CAST(o_orderdate AS DATE) AS opened, l.sector_code,
               CAST(c_nationkey * 10 + list_position({list(SEGMENTS)}, c_mktsegment) AS BIGINT)
                   AS muni_code, r_name AS uf, o_orderstatus AS status,
               l.status_date
        FROM orders JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
             LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS sector_code,
                               CAST(max(l_shipdate) AS DATE) AS status_date
                        FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l_orderkey""",
    "sec": "SELECT p_partkey AS codigo, p_type || ' ' || p_brand AS descricao FROM part",
    "mun": f"""SELECT CAST(n_nationkey * 10 + k AS BIGINT) AS codigo,
                      n_name || ' ' || {list(SEGMENTS)}[k] AS descricao
        FROM nation, range(1, {len(SEGMENTS) + 1}) AS r(k)""",
    "nat": """SELECT DISTINCT c_mktsegment || '-' || p AS codigo,
                     'Natureza ' || c_mktsegment || '-' || p AS descricao
        FROM customer, range(1, 6) AS r(p)""",
    "ent": "SELECT " + _sql_layout(ENTITY, {
        "cnpj_basico": _raw_id_sql("o_orderkey"),
        "razao_social": "c_name",
        "natureza_juridica": "CASE WHEN c_acctbal < 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END",
        "capital_social": "CASE o_orderkey % 101 WHEN 1 THEN '1.234,56' "
                          "WHEN 2 THEN '20000000000000000,00' WHEN 3 THEN 'n/d' WHEN 4 THEN '' "
                          f"ELSE replace(CAST({_capital} AS VARCHAR), '.', ',') END",
        "porte_empresa": "o_orderpriority",
    }) + " FROM orders JOIN customer ON o_custkey = c_custkey",
    "est": "SELECT " + _sql_layout(ESTABLISHMENT, {
        "cnpj_basico": _raw_id_sql("l_orderkey"),
        "cnpj_ordem": "lpad(CAST(l_linenumber AS VARCHAR), 4, '0')",
        "cnpj_dv": "'00'",
        "matriz_filial": "CAST(l_linenumber AS VARCHAR)",
        "nome_fantasia": "'É \"' || l_returnflag || '\";' || chr(10) || l_linestatus",
        "situacao_cadastral": "CASE WHEN l_discount = 0 THEN '' WHEN l_linestatus = 'F' THEN '08' "
                              "ELSE '02' END",
        "data_situacao": f"CASE WHEN l_linestatus = 'F' THEN {_shipped} ELSE '0' END",
        "data_inicio_atividade": "CASE WHEN l_partkey % 97 = 0 THEN '00000000' "
                                 "WHEN l_partkey % 89 = 0 THEN '20991231' "
                                 "WHEN l_partkey % 83 = 0 THEN '' WHEN l_partkey % 79 = 0 THEN NULL "
                                 f"ELSE {_shipped} END",
        "cnae_fiscal": "CASE WHEN l_partkey % 53 = 0 THEN '' ELSE CAST(l_partkey AS VARCHAR) END",
        "uf": "l_returnflag",
        "municipio": "CAST(l_suppkey AS VARCHAR)",
        "correio_eletronico": "''",
    }) + " FROM lineitem",
    "etl_gold": f"""
        SELECT repeat('0', greatest(0, 8 - length(ent.cnpj_basico))) || ent.cnpj_basico AS entity_id,
               razao_social AS name, TRY_CAST(natureza_juridica AS BIGINT) AS legal_nature,
               {AMOUNT_SQL} AS capital, {_compact.format("data_inicio_atividade")} AS opened,
               TRY_CAST(cnae_fiscal AS BIGINT) AS sector_code,
               TRY_CAST(municipio AS BIGINT) AS muni_code, uf,
               TRY_CAST(situacao_cadastral AS BIGINT) AS status,
               {_compact.format("data_situacao")} AS status_date
        FROM est INNER JOIN ent ON ltrim(est.cnpj_basico, '0') = ltrim(ent.cnpj_basico, '0')
        WHERE {_valid_opening} AND matriz_filial = '1'""",
    "spans": f"""
        SELECT sector_code, date_diff('day', opened, status_date) AS days FROM reg
        WHERE status = '{CLOSED}' AND status_date >= opened""",
    "mart_survival_sector": f"""
        SELECT * FROM (
            SELECT coalesce(descricao, 'CNAE ' || CAST(sector_code AS VARCHAR)) AS setor,
                   count(*) AS total, {mean_years("sum(days)", "count(*)", 2)} AS media, {_points}
            FROM spans LEFT JOIN sec ON sector_code = codigo GROUP BY 1)
        WHERE total >= {MIN_SECTOR}""",
    "mart_growth_muni": f"""
        SELECT ano, cod_municipio, coalesce(descricao, CAST(cod_municipio AS VARCHAR))
                   AS nome_municipio, total
        FROM (SELECT year(opened) AS ano, muni_code AS cod_municipio, count(*) AS total FROM reg
              WHERE opened >= DATE '{SINCE}' GROUP BY ALL) LEFT JOIN mun ON codigo = cod_municipio
        WHERE cod_municipio IS NOT NULL""",
    "mart_bubbles": """
        SELECT ano, cod_municipio, coalesce(descricao, CAST(cod_municipio AS VARCHAR))
                   AS nome_municipio, n AS total_empresas, CAST(amount AS DOUBLE) / n AS capital_medio
        FROM (SELECT year(opened) AS ano, muni_code AS cod_municipio, count(*) AS n,
                     sum(capital) AS amount FROM reg WHERE capital > 0 GROUP BY ALL)
             LEFT JOIN mun ON codigo = cod_municipio
        WHERE ano IS NOT NULL AND cod_municipio IS NOT NULL""",
    "mart_treemap": """
        SELECT left(CAST(sector_code AS VARCHAR), 2) AS divisao_cnae, count(*) AS total_empresas,
               CAST(sum(capital) AS DOUBLE) AS capital_total
        FROM reg WHERE capital >= 0 AND sector_code IS NOT NULL GROUP BY 1""",
    "mart_density_uf": "SELECT uf, count(*) AS total FROM reg WHERE uf IS NOT NULL GROUP BY uf",
    "mart_region_kpis": f"""
        SELECT left(CAST(muni_code AS VARCHAR), 2) AS cod_uf, count(*) AS total_empresas,
               {money_mean("sum(capital) FILTER (WHERE capital > 0)", "count(*) FILTER (WHERE capital > 0)")}
                   AS capital_medio,
               {percent(f"count(*) FILTER (WHERE status = '{ACTIVE}')", "count(*)", 1)} AS pct_ativas
        FROM reg GROUP BY 1""",
    "sample": "SELECT * FROM reg WHERE capital > 0 ORDER BY entity_id LIMIT 30000",
}


def with_views(sql: str) -> str:
    """The query with those views it uses, directly or through others, put before it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(VIEWS[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    views = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in needed)
    head, body = "WITH " + views, sql.strip()
    if body.upper().startswith("WITH "):
        return f"{head},\n{body[5:]}"
    return f"{head}\n{body}"
