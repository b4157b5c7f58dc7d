"""Column helpers on numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.schemas import MONEY

# What counts as an amount in the extracts.
AMOUNT = r"^ *-?[0-9]+([,.][0-9]{1,2})? *\z"


def to_long(c: Column) -> Column:
    """Whole number, NULL where the text is none."""
    return c.try_cast("bigint")


def to_int(c: Column) -> Column:
    return c.try_cast("int")


def decimal_comma(c: Column) -> Column:
    """Amount from text with a decimal comma: 0 where there is none, NULL where it is no amount.

    An amount has up to two decimals and no marks between thousands. Text that is none, and an amount
    too large for the column, is NULL and never 0: :func:`unreadable_amount` finds it.
    """
    amount = F.replace(c, F.lit(","), F.lit(".")).try_cast(MONEY)
    return F.when(c.isNull() | (F.trim(c) == ""), F.lit(0).cast(MONEY)).when(c.rlike(AMOUNT), amount)


def unreadable_amount(c: Column) -> Column:
    """True for text that should be an amount and cannot be kept as one."""
    return decimal_comma(c).isNull()


def round_ratio(num: Column, den: Column, decimals: int) -> Column:
    """``num / den`` rounded half away from zero, without floating-point error.

    Both sides are whole numbers. The quotient is scaled and rounded in integer arithmetic, so a
    ratio that ends in exactly 5 always rounds the same way. NULL when ``den`` is 0.
    """
    scale = 10**decimals
    wide = "decimal(38,0)"
    n = F.abs(num).cast(wide) * F.lit(2 * scale).cast("decimal(10,0)")
    d = F.nullif(den, F.lit(0)).cast("decimal(20,0)")
    quotient = F.call_function(
        "div", (n + d).cast(wide), d * F.lit(2).cast("decimal(1,0)")
    )
    return F.signum(num.cast("double")) * quotient.cast("double") / F.lit(float(scale))


def percent(num: Column, den: Column, decimals: int) -> Column:
    """``num`` as a percentage of ``den``, both counts; NULL when ``den`` is 0."""
    return round_ratio(num.cast("bigint") * F.lit(100), den, decimals)


def percent_or_zero(num: Column, den: Column) -> Column:
    """Unrounded percentage, 0 when there is nothing to divide by."""
    share = num.cast("double") / F.nullif(den, F.lit(0)).cast("double") * F.lit(100.0)
    return F.coalesce(share, F.lit(0.0))


def money_mean(total: Column, count: Column, decimals: int = 2) -> Column:
    """Mean of amounts with two decimals from their sum and count, rounded exactly."""
    cents = (total.cast("decimal(36,2)") * F.lit(100).cast("decimal(3,0)")).cast("decimal(38,0)")
    return round_ratio(cents, count * F.lit(100), decimals)
