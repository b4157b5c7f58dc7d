"""Lookup tables and the labels shown in reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.text import thousands

# Two-digit region prefix -> state.
STATE_OF_PREFIX = {
    "11": "RO", "12": "AC", "13": "AM", "14": "RR", "15": "PA", "16": "AP", "17": "TO",
    "21": "MA", "22": "PI", "23": "CE", "24": "RN", "25": "PB", "26": "PE", "27": "AL",
    "28": "SE", "29": "BA", "31": "MG", "32": "ES", "33": "RJ", "35": "SP", "41": "PR",
    "42": "SC", "43": "RS", "50": "MS", "51": "MT", "52": "GO", "53": "DF",
}

# Two-digit sector division -> short name.
DIVISION_NAMES = {
    "01": "Agricultura", "10": "Alimentos", "13": "Têxtil", "20": "Química",
    "23": "Minerais não-metálicos", "25": "Metal", "26": "Eletrônicos", "28": "Máquinas",
    "33": "Manutenção", "35": "Eletricidade", "41": "Construção Civil", "45": "Automotivo",
    "46": "Comércio Atacadista", "47": "Comércio Varejista", "49": "Transporte Terrestre",
    "52": "Armazenagem", "55": "Hospedagem", "56": "Alimentação", "58": "Publicações",
    "61": "Telecom", "62": "TI/Software", "63": "Dados/TI", "64": "Finanças", "65": "Seguros",
    "68": "Imobiliário", "69": "Jurídico", "70": "Gestão", "71": "Engenharia", "72": "P&D",
    "73": "Publicidade", "74": "Design/Foto", "75": "Veterinária", "77": "Locação",
    "78": "RH/Recrutamento", "79": "Turismo", "80": "Vigilância", "81": "Facilities",
    "82": "Administração", "84": "Administração Pública", "85": "Educação", "86": "Saúde",
    "87": "Assistência Social", "90": "Arte/Cultura", "93": "Esporte", "94": "Associações",
    "96": "Serviços Pessoais",
}

# Status code -> name.
STATUS_NAMES = {1: "Nula", 2: "Ativa", 3: "Suspensa", 4: "Inapta", 8: "Baixada"}

# Label texts.
DIVISION_FALLBACK = "Divisão "
SECTOR_FALLBACK = "CNAE "
GROUP_LABEL = ("Grupo ", " — ")
BADGES = ((1.0, "🟢 OK"), (5.0, "🟡 Atenção"))
BADGE_WORST = "🔴 Crítico"

# Upper edges (inclusive) of the capital bands, and their names.
BAND_EDGES = (10_000, 100_000, 1_000_000)
BAND_NAMES = ("Até 10k", "10k - 100k", "100k - 1M", "Acima de 1M")


def lookup(key: Column, table: Mapping, fallback: Column | None = None) -> Column:
    """Value of ``key`` in a small fixed table, ``fallback`` where it has none."""
    entries = [F.lit(part) for pair in table.items() for part in pair]
    found = F.element_at(F.create_map(*entries), key)
    return found if fallback is None else F.coalesce(found, fallback)


def state_name(prefix: Column) -> Column:
    return lookup(prefix, STATE_OF_PREFIX, prefix)


def division_name(division: Column) -> Column:
    return lookup(division, DIVISION_NAMES, F.concat(F.lit(DIVISION_FALLBACK), division))


def status_name(status: Column) -> Column:
    return lookup(status, STATUS_NAMES, status.cast("string"))


def code_or_name(name: Column, code: Column) -> Column:
    """Name of a code, or the code itself where it has none."""
    return F.coalesce(name, code.cast("string"))


def sector_label(name: Column, code: Column) -> Column:
    """Sector name, 'CNAE n' where it has none, NULL where there is no code either."""
    return F.coalesce(name, F.concat(F.lit(SECTOR_FALLBACK), code.cast("string")))


def counted(name: Column, n: Column, dots: bool = False) -> Column:
    """'name (1,234)', with dots instead of commas if asked."""
    number = thousands(n) if dots else F.format_number(n, 0)
    return F.concat(name, F.lit(" ("), number, F.lit(")"))


def region_label(prefix: Column, top_name: Column, n: Column) -> Column:
    """'Grupo 35 — Osasco (1.234)'."""
    lead, dash = GROUP_LABEL
    name = F.coalesce(top_name, F.lit("?"))
    return counted(F.concat(F.lit(lead), prefix, F.lit(dash), name), n, dots=True)


def badge(pct: Column) -> Column:
    """Traffic light for a percentage of bad records."""
    shown = F.lit(BADGE_WORST)
    for limit, text in reversed(BADGES):
        shown = F.when(pct < limit, F.lit(text)).otherwise(shown)
    return shown


def band(
    amount: Column,
    edges: Sequence[float] = BAND_EDGES,
    names: Sequence[str] = BAND_NAMES,
) -> Column:
    """Name of the band an amount falls in; bands include their upper edge, none is below 0."""
    if len(names) != len(edges) + 1:
        raise ValueError("one more name than edges is needed")
    shown = F.lit(names[-1])
    for edge, name in reversed(list(zip(edges, names))):
        shown = F.when(amount <= F.lit(edge), F.lit(name)).otherwise(shown)
    return F.when(amount > 0, shown)
