"""Single operators: projections, predicates, joins, aggregates, windows, sorts, functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions import dates, labels, numbers, text
from rollcall.operators import aggregates, filters, joins, topk, windows
from rollcall.plans import compare, gold, marts, strategic
from rollcall.suite.binding import (
    AMOUNT_SQL,
    AS_OF,
    CLOSED,
    DUE_UFS,
    MUNIS,
    VALID_OPENING,
    Star,
    mean_years,
    percent,
)
from rollcall.suite.registry import case

_DAYS = f"date_diff('day', opened, DATE '{AS_OF}')"

# --- projections, filters, predicates -----------------------------------------------------------


@case("project_alias", """
    SELECT name AS razao_social, CAST(capital AS DOUBLE) AS capital_social,
           CAST(opened AS VARCHAR) AS data_abertura FROM reg""")
def _(s: Star) -> DataFrame:
    return s.reg.select(
        F.col("name").alias("razao_social"),
        F.col("capital").alias("capital_social"),
        F.col("opened").alias("data_abertura"),
    )


@case("filter_positive", "SELECT entity_id, CAST(capital AS DOUBLE) AS capital FROM reg "
                         "WHERE capital > 0")
def _(s: Star) -> DataFrame:
    return s.reg.where(F.col("capital") > 0).select("entity_id", "capital")


@case("filter_head_office", "SELECT cnpj_basico, cnpj_ordem FROM est WHERE matriz_filial = '1'")
def _(s: Star) -> DataFrame:
    return gold.head_offices(s.est).select("cnpj_basico", "cnpj_ordem")


@case("filter_date_regex", """
    SELECT cnpj_basico, data_inicio_atividade FROM est
    WHERE regexp_full_match(data_inicio_atividade, '[0-9]{8}')""")
def _(s: Star) -> DataFrame:
    day = F.col("data_inicio_atividade")
    return s.est.where(dates.is_compact_date(day)).select("cnpj_basico", "data_inicio_atividade")


@case("filter_date_range", f"""
    SELECT cnpj_basico, data_inicio_atividade FROM est
    WHERE CAST(try_strptime(data_inicio_atividade, '%Y%m%d') AS DATE)
          BETWEEN DATE '1900-01-01' AND DATE '{AS_OF}'""")
def _(s: Star) -> DataFrame:
    day = dates.parse_compact(F.col("data_inicio_atividade"))
    inside = day.between(F.lit(dates.FIRST_PLAUSIBLE), dates.as_date(AS_OF))
    return s.est.where(inside).select("cnpj_basico", "data_inicio_atividade")


@case("filter_not_null", "SELECT entity_id, sector_code FROM reg WHERE sector_code IS NOT NULL")
def _(s: Star) -> DataFrame:
    return s.reg.where(F.col("sector_code").isNotNull()).select("entity_id", "sector_code")


@case("filter_optional", """
    SELECT entity_id, uf, status FROM reg WHERE uf = 'ASIA'""")
def _(s: Star) -> DataFrame:
    return filters.where_equal(s.reg, uf="ASIA", status=None).select("entity_id", "uf", "status")


@case("filter_in_list", "SELECT entity_id, muni_code FROM reg WHERE muni_code IN (31, 72, 153)")
def _(s: Star) -> DataFrame:
    return filters.where_in(s.reg, "muni_code", MUNIS).select("entity_id", "muni_code")


@case("filter_isin_local", """
    SELECT ano, nome_municipio, total FROM mart_growth_muni
    WHERE nome_municipio IN ('NATION_3 AUTOMOBILE', 'NATION_7 BUILDING')""")
def _(s: Star) -> DataFrame:
    rows = filters.where_in(s.mart("mart_growth_muni"), "nome_municipio", ["NATION_3 AUTOMOBILE", "NATION_7 BUILDING"])
    return rows.select("ano", "nome_municipio", "total")


@case("filter_since", """
    SELECT entity_id, CAST(opened AS VARCHAR) AS opened FROM reg
    WHERE opened >= DATE '1998-06-15'""")
def _(s: Star) -> DataFrame:
    return filters.opened_since(s.reg, "1998-06-15").select("entity_id", "opened")


@case("filter_status", f"SELECT entity_id, status FROM reg WHERE status = '{CLOSED}'")
def _(s: Star) -> DataFrame:
    return s.reg.where(F.col("status") == CLOSED).select("entity_id", "status")


@case("filter_inverted_dates", f"""
    SELECT entity_id, date_diff('day', opened, status_date) AS days FROM reg
    WHERE status = '{CLOSED}' AND status_date >= opened""")
def _(s: Star) -> DataFrame:
    return filters.closed_spans(s.reg, CLOSED).select("entity_id", "days")


@case("filter_not", f"""
    SELECT cnpj_basico, data_inicio_atividade FROM est
    WHERE matriz_filial = '1' AND NOT {VALID_OPENING}""")
def _(s: Star) -> DataFrame:
    _, rest = filters.split_rows(
        gold.head_offices(s.est), dates.plausible_opening(F.col("data_inicio_atividade"), AS_OF)
    )
    return rest.select("cnpj_basico", "data_inicio_atividade")


@case("filter_prefix", """
    SELECT entity_id, sector_code FROM reg WHERE left(CAST(sector_code AS VARCHAR), 2) = '47'""")
def _(s: Star) -> DataFrame:
    return s.reg.where(text.code_prefix(F.col("sector_code")) == "47").select(
        "entity_id", "sector_code"
    )


# --- joins --------------------------------------------------------------------------------------


@case("join_gold", """
    SELECT e.cnpj_basico, e.razao_social, s.cnae_fiscal, s.uf
    FROM ent e JOIN est s ON e.cnpj_basico = s.cnpj_basico WHERE s.matriz_filial = '1'""")
def _(s: Star) -> DataFrame:
    heads = gold.head_offices(s.est).select("cnpj_basico", "cnae_fiscal", "uf")
    return s.ent.select("cnpj_basico", "razao_social").join(heads, "cnpj_basico")


@case("join_left_dim", """
    SELECT entity_id, sector_code, descricao AS setor FROM reg LEFT JOIN sec ON sector_code = codigo
    """)
def _(s: Star) -> DataFrame:
    rows = s.reg.select("entity_id", "sector_code")
    return joins.attach_name(rows, s.sec, "sector_code", "setor")


@case("join_star", """
    SELECT entity_id, s.descricao AS setor, m.descricao AS cidade FROM reg
    LEFT JOIN sec s ON sector_code = s.codigo LEFT JOIN mun m ON muni_code = m.codigo""")
def _(s: Star) -> DataFrame:
    rows = joins.attach_name(s.reg, s.sec, "sector_code", "setor")
    rows = joins.attach_name(rows, s.mun, "muni_code", "cidade")
    return rows.select("entity_id", "setor", "cidade")


@case("join_inner_dim", """
    SELECT entity_id, descricao AS natureza FROM reg JOIN nat ON legal_nature = codigo""")
def _(s: Star) -> DataFrame:
    rows = s.reg.select("entity_id", "legal_nature")
    named = joins.attach_name(rows, s.nat, "legal_nature", "natureza", how="inner")
    return named.select("entity_id", "natureza")


@case("join_agg_totals", """
    WITH g AS (SELECT uf, muni_code, count(*) AS qtd FROM reg GROUP BY uf, muni_code),
         t AS (SELECT uf, CAST(sum(qtd) AS BIGINT) AS total FROM g GROUP BY uf)
    SELECT g.uf, muni_code, qtd, total FROM g JOIN t ON g.uf = t.uf""")
def _(s: Star) -> DataFrame:
    grouped = aggregates.count_by(s.reg, "uf", "muni_code", name="qtd")
    return grouped.withColumn("total", F.sum("qtd").over(Window.partitionBy("uf")))


_DIV = "left(CAST(sector_code AS VARCHAR), 2)"


@case("join_topk_filter", f"""
    SELECT uf, {_DIV} AS divisao, count(*) AS qtd FROM reg
    WHERE {_DIV} IN (SELECT {_DIV} FROM reg WHERE sector_code IS NOT NULL GROUP BY {_DIV}
                     ORDER BY count(*) DESC, {_DIV} LIMIT 8)
    GROUP BY ALL""")
def _(s: Star) -> DataFrame:
    known = s.reg.where(F.col("sector_code").isNotNull())
    division = text.code_prefix(F.col("sector_code")).alias("divisao")
    grouped = aggregates.count_by(known, "uf", division, name="qtd")
    top = topk.top_groups(grouped, "divisao", F.sum("qtd"), 8, "total")
    return joins.keep_groups(grouped, top, "divisao").select("uf", "divisao", "qtd")


@case("semi_in_topk", """
    SELECT ano, cod_municipio, total_empresas FROM mart_bubbles WHERE ano IN (
        SELECT ano FROM mart_bubbles GROUP BY ano ORDER BY sum(total_empresas) DESC, ano LIMIT 3)
    """)
def _(s: Star) -> DataFrame:
    rows = marts.bubbles_top_years(s.mart("mart_bubbles"), 3)
    return rows.select("ano", "cod_municipio", "total_empresas")


@case("unmatched_count", """
    SELECT count(*) FILTER (WHERE codigo IS NULL) AS nao_mapeado
    FROM reg LEFT JOIN sec ON sector_code = codigo""")
def _(s: Star) -> DataFrame:
    rows = joins.unmatched(aggregates.count_by(s.reg, "sector_code"), s.sec, "sector_code")
    return rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("nao_mapeado"))


_TOP_MUNI = """
    SELECT uf, muni_code AS cod_municipio, qtd FROM (
        SELECT uf, muni_code, count(*) AS qtd,
               row_number() OVER (PARTITION BY uf ORDER BY count(*) DESC, muni_code) AS r
        FROM reg GROUP BY uf, muni_code) WHERE r = 1"""


@case("join_top_row_back", f"""
    WITH topo AS ({_TOP_MUNI})
    SELECT r.uf, count(*) AS total_empresas, m.descricao AS municipio_mais_comum
    FROM reg r JOIN topo t ON r.uf = t.uf LEFT JOIN mun m ON m.codigo = t.cod_municipio
    GROUP BY r.uf, m.descricao""")
def _(s: Star) -> DataFrame:
    rows = compare.regions_available(s.reg, s.mun, by="uf")
    return rows.select("uf", "total_empresas", "municipio_mais_comum")


# --- aggregates ---------------------------------------------------------------------------------


@case("agg_count", "SELECT uf, count(*) AS n FROM reg GROUP BY uf")
def _(s: Star) -> DataFrame:
    return aggregates.count_by(s.reg, "uf")


@case("agg_count_distinct", """
    SELECT count(*) - count(DISTINCT entity_id) AS repetidos FROM etl_gold""")
def _(s: Star) -> DataFrame:
    by_id = aggregates.count_by(s.etl_gold(), "entity_id")
    return by_id.agg((F.sum("n") - F.count("entity_id")).alias("repetidos"))


@case("agg_sum", "SELECT uf, CAST(sum(capital) AS DOUBLE) AS capital FROM reg GROUP BY uf")
def _(s: Star) -> DataFrame:
    return s.reg.groupBy("uf").agg(F.sum("capital").alias("capital"))


@case("agg_avg", """
    SELECT uf, CAST(sum(capital) AS DOUBLE) / count(capital) AS capital_medio FROM reg GROUP BY uf
    """)
def _(s: Star) -> DataFrame:
    mean = F.sum("capital").cast("double") / F.count("capital")
    return s.reg.groupBy("uf").agg(mean.alias("capital_medio"))


@case("agg_min_max", """
    SELECT uf, CAST(min(opened) AS VARCHAR) AS mais_antiga, CAST(max(opened) AS VARCHAR)
           AS mais_recente FROM reg GROUP BY uf""")
def _(s: Star) -> DataFrame:
    return s.reg.groupBy("uf").agg(
        F.min("opened").alias("mais_antiga"), F.max("opened").alias("mais_recente")
    )


@case("agg_filter", f"""
    SELECT uf, count(*) FILTER (WHERE status = '{CLOSED}') AS baixadas,
           count(*) FILTER (WHERE capital > 0) AS com_capital FROM reg GROUP BY uf""")
def _(s: Star) -> DataFrame:
    return s.reg.groupBy("uf").agg(
        F.count_if(F.col("status") == CLOSED).alias("baixadas"),
        F.count_if(F.col("capital") > 0).alias("com_capital"),
    )


_SIX = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95}


@case("agg_percentile", "SELECT uf, count(*) AS total, " + ", ".join(
    f"round(quantile_cont(CAST({_DAYS} AS DOUBLE), {p}), 4) AS {n}" for n, p in _SIX.items()
) + " FROM reg GROUP BY uf")
def _(s: Star) -> DataFrame:
    days = dates.days_between(F.col("opened"), dates.as_date(AS_OF)).alias("days")
    counts = aggregates.count_by(s.reg, "uf", days)
    spread = aggregates.spread_of_days(counts, "uf", probs=_SIX)
    return spread.select("uf", "total", *[F.round(n, 4).alias(n) for n in _SIX])


@case("agg_group_expr", "SELECT year(opened) AS ano, count(*) AS n FROM reg GROUP BY year(opened)")
def _(s: Star) -> DataFrame:
    return aggregates.count_by(s.reg, F.year("opened").alias("ano"))


@case("agg_having", """
    SELECT muni_code, count(*) AS n FROM reg GROUP BY muni_code HAVING count(*) >= 600""")
def _(s: Star) -> DataFrame:
    return aggregates.count_by(s.reg, "muni_code").where(F.col("n") >= 600)


@case("agg_distinct", "SELECT DISTINCT uf, legal_nature FROM reg")
def _(s: Star) -> DataFrame:
    return s.reg.select("uf", "legal_nature").distinct()


@case("agg_of_agg", """
    SELECT CAST(max(c) AS BIGINT) AS maior, CAST(sum(c) AS BIGINT) AS total FROM (
        SELECT count(*) AS c FROM reg GROUP BY year(opened) // 10)""")
def _(s: Star) -> DataFrame:
    by_decade = aggregates.count_by(s.reg, dates.decade(F.col("opened")).alias("decada"))
    return by_decade.agg(F.max("n").alias("maior"), F.sum("n").alias("total"))


@case("agg_weighted", """
    SELECT sum(media * total) / sum(total) AS media_geral,
           sum(mediana * total) / sum(total) AS mediana_geral FROM mart_survival_sector""")
def _(s: Star) -> DataFrame:
    return s.mart("mart_survival_sector").agg(
        aggregates.weighted_mean("media", "total").alias("media_geral"),
        aggregates.weighted_mean("mediana", "total").alias("mediana_geral"),
    )


@case("agg_pivot", """
    SELECT legal_nature, """ + ", ".join(
    f"CAST(count(*) FILTER (WHERE uf = '{u}') AS DOUBLE) AS {u}" for u in DUE_UFS
) + f" FROM reg WHERE uf IN ({', '.join(repr(u) for u in DUE_UFS)}) GROUP BY legal_nature")
def _(s: Star) -> DataFrame:
    rows = filters.where_in(s.reg, "uf", DUE_UFS)
    counts = aggregates.count_by(rows, "legal_nature", "uf")
    return aggregates.pivot_sum(counts, "legal_nature", "uf", "n", DUE_UFS)


@case("agg_group_size", """
    SELECT sector_code, count(*) AS qtd FROM reg WHERE sector_code IS NOT NULL
    GROUP BY sector_code""")
def _(s: Star) -> DataFrame:
    known = s.reg.where(F.col("sector_code").isNotNull())
    return aggregates.count_by(known, "sector_code", name="qtd")


@case("agg_mean_group", """
    SELECT legal_nature, CAST(sum(capital) AS DOUBLE) / count(*) AS capital_medio FROM reg
    WHERE capital > 0 GROUP BY legal_nature""")
def _(s: Star) -> DataFrame:
    mean = F.sum("capital").cast("double") / F.count(F.lit(1))
    positive = s.reg.where(F.col("capital") > 0)
    return positive.groupBy("legal_nature").agg(mean.alias("capital_medio"))


@case("agg_share", f"""
    SELECT uf, {percent("count(*) FILTER (WHERE capital = 0)", "count(*)", 1)} AS pct FROM reg
    GROUP BY uf""")
def _(s: Star) -> DataFrame:
    share = numbers.percent(F.count_if(F.col("capital") == 0), F.count(F.lit(1)), 1)
    return s.reg.groupBy("uf").agg(share.alias("pct"))


# --- windows ------------------------------------------------------------------------------------


@case("win_share_total", f"""
    SELECT status, n, {percent("n", "sum(n) OVER ()", 1)} AS pct
    FROM (SELECT status, count(*) AS n FROM reg GROUP BY status)""")
def _(s: Star) -> DataFrame:
    return windows.with_share(aggregates.count_by(s.reg, "status"), "n")


@case("win_distinct_on", _TOP_MUNI)
def _(s: Star) -> DataFrame:
    return compare.largest_by_region(s.reg)


# --- sorts, limits, top-k -----------------------------------------------------------------------


@case("sort_multi", """
    SELECT uf, status, count(*) AS n FROM reg GROUP BY uf, status
    ORDER BY uf, n DESC NULLS LAST, status""")
def _(s: Star) -> DataFrame:
    return aggregates.count_by(s.reg, "uf", "status").orderBy(
        "uf", F.col("n").desc_nulls_last(), "status"
    )


@case("limit_sample", "SELECT entity_id, name FROM sample")
def _(s: Star) -> DataFrame:
    positive = s.reg.where(F.col("capital") > 0).select("entity_id", "name")
    return strategic.sample(positive, strategic.SAMPLE_ROWS)


@case("limit_sample_500", """
    SELECT entity_id, CAST(capital AS DOUBLE) AS capital FROM reg WHERE capital > 0
    ORDER BY entity_id LIMIT 500""")
def _(s: Star) -> DataFrame:
    positive = s.reg.where(F.col("capital") > 0).select("entity_id", "capital")
    return strategic.sample(positive, 500)


@case("topk_sort", """
    SELECT entity_id, CAST(capital AS DOUBLE) AS capital FROM reg WHERE capital > 0
    ORDER BY reg.capital DESC, entity_id LIMIT 100""")
def _(s: Star) -> DataFrame:
    positive = s.reg.where(F.col("capital") > 0).select("entity_id", "capital")
    return topk.largest_rows(positive, 100, "capital", "entity_id")


@case("topk_groups", """
    SELECT muni_code, CAST(sum(capital) AS DOUBLE) AS capital FROM reg
    WHERE muni_code IS NOT NULL GROUP BY muni_code
    ORDER BY sum(reg.capital) DESC, muni_code LIMIT 10""")
def _(s: Star) -> DataFrame:
    return topk.top_groups(s.reg, "muni_code", F.sum("capital"), 10, "capital")


@case("sorted_distinct", """
    SELECT DISTINCT nome_municipio FROM mart_bubbles ORDER BY nome_municipio LIMIT 20""")
def _(s: Star) -> DataFrame:
    return marts.first_names(s.mart("mart_bubbles"), 20)


# --- subqueries ---------------------------------------------------------------------------------


@case("scalar_subquery", """
    SELECT uf, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM reg) AS parte FROM reg GROUP BY uf
    """)
def _(s: Star) -> DataFrame:
    total = s.reg.agg(F.count(F.lit(1))).scalar()
    part = F.col("n").cast("double") / total
    return aggregates.count_by(s.reg, "uf").select("uf", part.alias("parte"))


@case("cte_chain", f"""
    SELECT uf, divisao, {percent("n", "sum(n) OVER (PARTITION BY uf)", 2)} AS pct
    FROM (SELECT uf, {_DIV} AS divisao, count(*) AS n FROM reg WHERE sector_code IS NOT NULL
          GROUP BY ALL)""")
def _(s: Star) -> DataFrame:
    known = s.reg.where(F.col("sector_code").isNotNull())
    base = aggregates.count_by(
        known, "uf", text.code_prefix(F.col("sector_code")).alias("divisao"), name="qtd"
    )
    total = F.sum("qtd").over(Window.partitionBy("uf"))
    return base.withColumn("total", total).select(
        "uf", "divisao", numbers.percent(F.col("qtd"), F.col("total"), 2).alias("pct")
    )


@case("derived_table", f"""
    SELECT status, CAST(max(days) AS BIGINT) AS maior, count(*) AS n
    FROM (SELECT status, {_DAYS} AS days FROM reg WHERE capital > 0) GROUP BY status""")
def _(s: Star) -> DataFrame:
    days = dates.days_between(F.col("opened"), dates.as_date(AS_OF)).alias("days")
    inner = s.reg.where(F.col("capital") > 0).select("status", days)
    return inner.groupBy("status").agg(F.max("days").alias("maior"), F.count(F.lit(1)).alias("n"))


# --- scalar functions ---------------------------------------------------------------------------


@case("fn_lpad", """
    SELECT cnpj_basico, repeat('0', greatest(0, 8 - length(cnpj_basico))) || cnpj_basico AS id
    FROM ent""")
def _(s: Star) -> DataFrame:
    return s.ent.select("cnpj_basico", text.pad_id(F.col("cnpj_basico")).alias("id"))


@case("fn_nullif", """
    SELECT cnpj_basico, nullif(cnae_fiscal, '') AS cnae, nullif(data_situacao, '0') AS situacao
    FROM est""")
def _(s: Star) -> DataFrame:
    return s.est.select(
        "cnpj_basico",
        text.blank_to_null(F.col("cnae_fiscal")).alias("cnae"),
        text.blank_to_null(F.col("data_situacao"), "0").alias("situacao"),
    )


@case("fn_decimal_comma", """
    SELECT cnpj_basico, CAST(""" + AMOUNT_SQL + """ AS DOUBLE) AS capital FROM ent""")
def _(s: Star) -> DataFrame:
    return s.ent.select(
        "cnpj_basico", numbers.decimal_comma(F.col("capital_social")).alias("capital")
    )


@case("fn_cast", """
    SELECT cnpj_basico, TRY_CAST(cnae_fiscal AS BIGINT) AS cnae,
           TRY_CAST(situacao_cadastral AS BIGINT) AS situacao FROM est""")
def _(s: Star) -> DataFrame:
    return s.est.select(
        "cnpj_basico",
        numbers.to_long(F.col("cnae_fiscal")).alias("cnae"),
        numbers.to_int(F.col("situacao_cadastral")).alias("situacao"),
    )


@case("fn_coalesce_code", """
    SELECT entity_id, coalesce(descricao, CAST(muni_code AS VARCHAR)) AS nome
    FROM reg LEFT JOIN mun ON muni_code = codigo
         AND codigo // 10 IN (SELECT s_nationkey FROM supplier)""")
def _(s: Star) -> DataFrame:
    sites = s.table("supplier").select("s_nationkey")  # nations without a supplier have no name
    partial = s.mun.join(sites, F.expr("codigo div 10") == F.col("s_nationkey"), "left_semi")
    rows = joins.attach_name(s.reg, partial, "muni_code", "descricao")
    name = labels.code_or_name(F.col("descricao"), F.col("muni_code"))
    return rows.select("entity_id", name.alias("nome"))


@case("fn_coalesce_label", """
    SELECT entity_id, coalesce(descricao, 'CNAE ' || CAST(sector_code AS VARCHAR)) AS setor
    FROM reg LEFT JOIN sec ON sector_code = codigo""")
def _(s: Star) -> DataFrame:
    rows = joins.attach_name(s.reg, s.sec, "sector_code", "descricao")
    label = labels.sector_label(F.col("descricao"), F.col("sector_code"))
    return rows.select("entity_id", label.alias("setor"))


@case("fn_to_date", """
    SELECT cnpj_basico, CAST(CAST(try_strptime(data_inicio_atividade, '%Y%m%d') AS DATE) AS VARCHAR)
           AS dia FROM est""")
def _(s: Star) -> DataFrame:
    day = dates.parse_compact(F.col("data_inicio_atividade"))
    return s.est.select("cnpj_basico", day.alias("dia"))


@case("fn_prefix", f"""
    SELECT entity_id, {_DIV} AS divisao,
           left(lpad(CAST(sector_code AS VARCHAR), 7, '0'), 2) AS corrigida FROM reg""")
def _(s: Star) -> DataFrame:
    code = F.col("sector_code")
    return s.reg.select(
        "entity_id",
        text.code_prefix(code).alias("divisao"),
        text.code_prefix(code, pad=7).alias("corrigida"),
    )


@case("fn_year", "SELECT entity_id, year(opened) AS ano FROM reg")
def _(s: Star) -> DataFrame:
    return s.reg.select("entity_id", F.year("opened").alias("ano"))


@case("fn_decade", "SELECT entity_id, (year(opened) // 10) * 10 AS decada FROM reg")
def _(s: Star) -> DataFrame:
    return s.reg.select("entity_id", dates.decade(F.col("opened")).alias("decada"))


@case("fn_age_years", f"SELECT entity_id, {_DAYS} / 365.25 AS anos FROM reg")
def _(s: Star) -> DataFrame:
    days = dates.days_between(F.col("opened"), dates.as_date(AS_OF))
    return s.reg.select("entity_id", dates.years(days).alias("anos"))


@case("fn_round", f"""
    SELECT muni_code, {mean_years(f"sum({_DAYS})", "count(*)", 1)} AS uma,
           {mean_years(f"sum({_DAYS})", "count(*)", 2)} AS duas FROM reg GROUP BY muni_code""")
def _(s: Star) -> DataFrame:
    days = dates.days_between(F.col("opened"), dates.as_date(AS_OF))
    sums = s.reg.groupBy("muni_code").agg(
        F.sum(days).alias("sum_days"), F.count(F.lit(1)).alias("total")
    )
    return sums.select(
        "muni_code", marts.mean_years(1).alias("uma"), marts.mean_years(2).alias("duas")
    )


def _map_sql(table: dict) -> str:
    pairs = ", ".join(f"'{k}': '{v}'" for k, v in table.items())
    return f"MAP {{{pairs}}}"


@case("fn_lookup_map", f"""
    SELECT entity_id,
           coalesce({_map_sql(labels.DIVISION_NAMES)}[{_DIV}], 'Divisão ' || {_DIV}) AS setor,
           coalesce({_map_sql(labels.STATE_OF_PREFIX)}[left(CAST(muni_code AS VARCHAR), 2)],
                    left(CAST(muni_code AS VARCHAR), 2)) AS sigla FROM reg""")
def _(s: Star) -> DataFrame:
    division = text.code_prefix(F.col("sector_code"))
    return s.reg.select(
        "entity_id",
        labels.division_name(division).alias("setor"),
        labels.state_name(text.code_prefix(F.col("muni_code"))).alias("sigla"),
    )


_DOTS = "replace(format('{:,}', %s), ',', '.')"


@case("fn_label", f"""
    SELECT muni_code, 'Grupo ' || CAST(muni_code AS VARCHAR) || ' — ' || descricao || ' ('
           || {_DOTS % "count(*)"} || ')' AS label
    FROM reg LEFT JOIN mun ON muni_code = codigo GROUP BY muni_code, descricao""")
def _(s: Star) -> DataFrame:
    counts = aggregates.count_by(s.reg, "muni_code")
    rows = joins.attach_name(counts, s.mun, "muni_code", "descricao")
    code = F.col("muni_code").cast("string")
    label = labels.region_label(code, F.col("descricao"), F.col("n"))
    return rows.select("muni_code", label.alias("label"))


@case("fn_money_br", """
    SELECT entity_id, translate(format('{:,.2f}', CAST(capital AS DOUBLE)), ',.', '.,') AS valor
    FROM reg""")
def _(s: Star) -> DataFrame:
    return s.reg.select("entity_id", text.money(F.col("capital")).alias("valor"))


@case("fn_band", """
    SELECT entity_id, CASE WHEN capital <= 0 THEN NULL WHEN capital <= 10000 THEN 'Até 10k'
           WHEN capital <= 100000 THEN '10k - 100k' WHEN capital <= 1000000 THEN '100k - 1M'
           ELSE 'Acima de 1M' END AS faixa FROM reg""")
def _(s: Star) -> DataFrame:
    return s.reg.select("entity_id", labels.band(F.col("capital")).alias("faixa"))


@case("fn_to_numeric", """
    SELECT cnpj_basico, TRY_CAST(cnae_fiscal AS BIGINT) AS numero,
           TRY_CAST(uf AS BIGINT) AS invalido FROM est""")
def _(s: Star) -> DataFrame:
    return s.est.select(
        "cnpj_basico",
        numbers.to_long(F.col("cnae_fiscal")).alias("numero"),
        numbers.to_long(F.col("uf")).alias("invalido"),
    )


@case("fn_trim", "SELECT p_partkey AS codigo, p_type AS descricao FROM part")
def _(s: Star) -> DataFrame:
    padded = F.concat(F.lit(" \t"), F.col("p_type"), F.lit(" \n "))
    return s.table("part").select(
        F.col("p_partkey").alias("codigo"), text.strip_space(padded).alias("descricao")
    )


@case("fn_badge", """
    SELECT muni_code, CASE WHEN pct < 1 THEN '🟢 OK' WHEN pct < 5 THEN '🟡 Atenção'
                           ELSE '🔴 Crítico' END AS badge
    FROM (SELECT muni_code, CAST(count(*) FILTER (WHERE sector_code IS NULL) AS DOUBLE)
                 / count(*) * 100 AS pct FROM reg GROUP BY muni_code)""")
def _(s: Star) -> DataFrame:
    missing = F.count_if(F.col("sector_code").isNull())
    pct = numbers.percent_or_zero(missing, F.count(F.lit(1)))
    rows = s.reg.groupBy("muni_code").agg(pct.alias("pct"))
    return rows.select("muni_code", labels.badge(F.col("pct")).alias("badge"))


@case("fn_pct_safe", """
    SELECT muni_code, CASE WHEN count(sector_code) > 0 THEN
           CAST(count(*) FILTER (WHERE capital = 0) AS DOUBLE) / count(sector_code) * 100
           ELSE 0 END AS pct FROM reg GROUP BY muni_code""")
def _(s: Star) -> DataFrame:
    pct = numbers.percent_or_zero(F.count_if(F.col("capital") == 0), F.count("sector_code"))
    return s.reg.groupBy("muni_code").agg(pct.alias("pct"))


@case("fn_truncate", "SELECT entity_id, left(name || ' / ' || name || ' / ' || uf, 40) AS rotulo "
                     "FROM reg")
def _(s: Star) -> DataFrame:
    label = F.concat("name", F.lit(" / "), "name", F.lit(" / "), "uf")
    return s.reg.select("entity_id", text.truncate(label).alias("rotulo"))


@case("fn_date_key", "SELECT entity_id, strftime(opened, '%Y%m%d') AS chave FROM reg")
def _(s: Star) -> DataFrame:
    return s.reg.select("entity_id", dates.date_key(F.col("opened")).alias("chave"))
