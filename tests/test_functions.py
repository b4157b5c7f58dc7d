"""Column helpers on hand-written rows."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.functions import dates, labels, numbers, text


def column(spark, values, kind, build):
    """The helper's result for each value, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    rows = df.select("i", build(F.col("x")).alias("y")).collect()
    return [r["y"] for r in sorted(rows)]


def test_pad_id_fills_and_never_cuts(spark):
    got = column(spark, ["123", "12345678", "123456781", "123456782", None], "string", text.pad_id)
    assert got == ["00000123", "12345678", "123456781", "123456782", None]


def test_has_prefix_is_code_prefix(spark):
    codes = [0, 1, 7, 12, 13, 120, 129, 130, 1299, 12 * 10**17, 92 * 10**17, 2**63 - 1, -12, -1, None]
    for prefixes in (["12"], ["1"], ["92", "7"], ["-1"], ["0", "13"], ["012", "x", ""], []):
        want = [None if c is None else str(c)[:2] in prefixes for c in codes]
        got = column(spark, codes, "bigint", lambda c: text.has_prefix(c, prefixes))
        assert [bool(g) for g in got] == [bool(w) for w in want], prefixes


def test_blank_to_null(spark):
    assert column(spark, ["", "0", "7", None], "string", text.blank_to_null) == [
        None, "0", "7", None,
    ]
    assert column(spark, ["", "0", "00000000"], "string", lambda c: text.blank_to_null(c, "0")) == [
        "", None, "00000000",
    ]


def test_strip_space_takes_every_kind(spark):
    got = column(spark, ["\t a b \n", " x ", "", None], "string", text.strip_space)
    assert got == ["a b", "x", "", None]


def test_nul_is_dropped_and_counted(spark):
    values = ["a\x00b\x00", "\x00", "é", None]
    assert column(spark, values, "string", text.strip_nul) == ["ab", "", "é", None]
    assert column(spark, values, "string", text.nul_count) == [2, 1, 0, 0]


def test_code_prefix_with_and_without_lost_zeros(spark):
    values = [111301, 4711301, 7, None]
    assert column(spark, values, "bigint", text.code_prefix) == ["11", "47", "7", None]
    padded = column(spark, values, "bigint", lambda c: text.code_prefix(c, pad=7))
    assert padded == ["01", "47", "00", None]


def test_number_texts(spark):
    assert column(spark, [1234567, 5], "bigint", text.thousands) == ["1.234.567", "5"]
    amounts = [Decimal("1234567.80"), Decimal("0.05")]
    assert column(spark, amounts, "decimal(18,2)", text.money) == ["1.234.567,80", "0,05"]
    assert column(spark, ["x" * 50], "string", text.truncate) == ["x" * 40]


def test_decimal_comma(spark):
    values = ["1234,50", "0,00", "", None, "  ", "1000000,00", "12,3", "7", "-5,00", " 8,00 "]
    got = column(spark, values, "string", numbers.decimal_comma)
    want = ("1234.50", "0", "0", "0", "0", "1000000", "12.3", "7", "-5", "8")
    assert got == [Decimal(v) for v in want]


def test_what_is_no_amount_is_null_and_found(spark):
    values = ["abc", "1.234,56", "20000000000000000,00", "12,345", "1,2,3", ",5"]
    assert column(spark, values, "string", numbers.decimal_comma) == [None] * len(values)
    assert all(column(spark, values, "string", numbers.unreadable_amount))
    assert not any(column(spark, ["", None, "1,00"], "string", numbers.unreadable_amount))


def test_to_long_rejects_what_is_no_number(spark):
    values = ["0111301", "", "n/d", None]
    assert column(spark, values, "string", numbers.to_long) == [111301, None, None, None]


@settings(max_examples=5, deadline=None)
@given(st.lists(
    st.tuples(st.integers(-10**15, 10**15), st.integers(1, 10**12), st.integers(0, 4)),
    min_size=20, max_size=60,
))
def test_round_ratio_is_exact(spark, triples):
    # Ratios that end in exactly 5 are the ones floating point gets wrong.
    triples = [*triples, (1005, 1000, 2), (-1005, 1000, 2), (25, 1000, 2), (0, 7, 1)]
    by_decimals = {}
    for num, den, decimals in triples:
        by_decimals.setdefault(decimals, []).append((num, den))
    for decimals, pairs in by_decimals.items():
        df = spark.createDataFrame(pairs, "num bigint, den bigint")
        got = df.select(
            "num", "den", numbers.round_ratio(F.col("num"), F.col("den"), decimals).alias("y")
        ).collect()
        for num, den, y in got:
            q = Fraction(abs(num), den) * 10**decimals
            whole = (2 * q.numerator + q.denominator) // (2 * q.denominator)
            want = (1 if num > 0 else -1 if num < 0 else 0) * whole / 10**decimals
            assert y == pytest.approx(want, rel=1e-15, abs=0)


def test_round_ratio_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 0), (None, 3)], "num bigint, den bigint")
    got = df.select(numbers.percent(F.col("num"), F.col("den"), 1).alias("y")).collect()
    assert [r.y for r in got] == [None, None]


def test_money_mean_matches_decimal_rounding(spark):
    amounts = [Decimal("0.01"), Decimal("0.02"), Decimal("1000000.00"), Decimal("0.05")]
    df = spark.createDataFrame([(a,) for a in amounts], "x decimal(18,2)")
    got = df.agg(numbers.money_mean(F.sum("x"), F.count("x")).alias("y")).first().y
    want = (sum(amounts) / len(amounts)).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert got == float(want)


def test_percent_or_zero(spark):
    df = spark.createDataFrame([(1, 4), (1, 0)], "n bigint, t bigint")
    got = df.select(numbers.percent_or_zero(F.col("n"), F.col("t")).alias("y")).collect()
    assert [r.y for r in got] == [25.0, 0.0]


def test_compact_dates(spark):
    values = ["20240229", "20240230", "00000000", "0", "", None, "20240101\n", "2024010a"]
    assert column(spark, values, "string", dates.parse_compact)[:6] == [
        dt.date(2024, 2, 29), None, None, None, None, None,
    ]
    assert column(spark, values, "string", dates.is_compact_date) == [
        True, True, True, False, False, None, False, False,
    ]


def test_plausible_opening_is_never_null(spark):
    values = ["19000101", "18991231", "20020101", "20020102", "00000000", "0", None, "20010230"]
    got = column(spark, values, "string", lambda c: dates.plausible_opening(c, "2002-01-01"))
    assert got == [True, False, True, False, False, False, False, False]


def test_decade_year_and_key(spark):
    days = [dt.date(1999, 12, 31), dt.date(2000, 1, 1), None]
    assert column(spark, days, "date", dates.decade) == [1990, 2000, None]
    assert column(spark, days, "date", dates.date_key) == ["19991231", "20000101", None]


def test_years_of_days(spark):
    assert column(spark, [1461], "int", dates.years) == [4.0]


def test_lookups_fall_back(spark):
    assert column(spark, ["35", "99", None], "string", labels.state_name) == ["SP", "99", None]
    assert column(spark, ["47", "99", None], "string", labels.division_name) == [
        "Comércio Varejista", "Divisão 99", None,
    ]
    assert column(spark, [8, 5, None], "int", labels.status_name) == ["Baixada", "5", None]


def test_name_fallbacks(spark):
    df = spark.createDataFrame(
        [("Varejo", 4711), (None, 4711), (None, None)], "name string, code bigint"
    )
    name, code = F.col("name"), F.col("code")
    rows = df.select(labels.code_or_name(name, code), labels.sector_label(name, code)).collect()
    assert [tuple(r) for r in rows] == [
        ("Varejo", "Varejo"), ("4711", "CNAE 4711"), (None, None),
    ]


def test_region_labels(spark):
    df = spark.createDataFrame([("35", "Osasco", 1234), ("11", None, 7)], "p string, m string, n long")
    p, m, n = F.col("p"), F.col("m"), F.col("n")
    rows = df.select(labels.region_label(p, m, n), labels.counted(m, n)).collect()
    assert [r[0] for r in rows] == ["Grupo 35 — Osasco (1.234)", "Grupo 11 — ? (7)"]
    assert rows[0][1] == "Osasco (1,234)"


def test_badges(spark):
    got = column(spark, [0.0, 0.99, 1.0, 4.99, 5.0], "double", labels.badge)
    assert got == ["🟢 OK", "🟢 OK", "🟡 Atenção", "🟡 Atenção", "🔴 Crítico"]


def test_bands_include_their_upper_edge(spark):
    values = [Decimal(v) for v in ("0", "0.01", "10000", "10000.01", "100000", "1000000", "1000001")]
    got = column(spark, [*values, None], "decimal(18,2)", labels.band)
    assert got == [
        None, "Até 10k", "Até 10k", "10k - 100k", "10k - 100k", "100k - 1M", "Acima de 1M", None,
    ]
    with pytest.raises(ValueError):
        labels.band(F.lit(1), (1, 2), ("a", "b"))
