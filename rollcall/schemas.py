"""Declared schemas of the registry layers and the column roles used by the library."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Positional layout of the published registry extracts.
ENTITY = _text(
    "cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel",
    "capital_social", "porte_empresa", "ente_federativo_responsavel",
)
ESTABLISHMENT = _text(
    "cnpj_basico", "cnpj_ordem", "cnpj_dv", "matriz_filial", "nome_fantasia",
    "situacao_cadastral", "data_situacao", "motivo_situacao", "nome_cidade_exterior", "pais",
    "data_inicio_atividade", "cnae_fiscal", "cnae_secundaria", "tipo_logradouro", "logradouro",
    "numero", "complemento", "bairro", "cep", "uf", "municipio", "ddd_1", "telefone_1", "ddd_2",
    "telefone_2", "ddd_fax", "fax", "correio_eletronico", "situacao_especial",
    "data_situacao_especial",
)
CODES_RAW = _text("codigo", "descricao")
CODES = T.StructType([
    T.StructField("codigo", T.LongType()),
    T.StructField("descricao", T.StringType()),
])

MONEY = T.DecimalType(18, 2)

# The validated table, one row per entity, under role names.
GOLD = T.StructType([
    T.StructField("entity_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("legal_nature", T.LongType()),
    T.StructField("capital", MONEY),
    T.StructField("opened", T.DateType()),
    T.StructField("sector_code", T.LongType()),
    T.StructField("muni_code", T.LongType()),
    T.StructField("uf", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("status_date", T.DateType()),
])

# Published name of each role.
PUBLISHED_NAMES = {
    "entity_id": "cnpj_basico",
    "name": "razao_social",
    "legal_nature": "natureza_juridica",
    "capital": "capital_social",
    "opened": "data_abertura",
    "sector_code": "cnae_fiscal",
    "muni_code": "cod_municipio",
    "uf": "uf",
    "status": "situacao_cadastral",
    "status_date": "data_situacao",
}


def to_roles(df: DataFrame) -> DataFrame:
    """Rename a table with published column names to role names."""
    return df.withColumnsRenamed({v: k for k, v in PUBLISHED_NAMES.items()})


def to_published(df: DataFrame) -> DataFrame:
    """Rename a table with role names to published column names."""
    return df.withColumnsRenamed(PUBLISHED_NAMES)


class ContractError(ValueError):
    """A table lacks declared columns or has other types."""


def contract_breaks(df: DataFrame, expected: T.StructType) -> list[str]:
    """Every difference between ``df`` and the declared schema, as readable text."""
    actual = {f.name: f.dataType for f in df.schema}
    breaks = []
    for field in expected:
        if field.name not in actual:
            breaks.append(f"{field.name}: missing")
        elif actual[field.name] != field.dataType:
            breaks.append(
                f"{field.name}: {actual[field.name].simpleString()} instead of "
                f"{field.dataType.simpleString()}"
            )
    return breaks


def require(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Pass ``df`` through when it meets the declared schema, else raise."""
    breaks = contract_breaks(df, expected)
    if breaks:
        raise ContractError("; ".join(breaks))
    return df
