"""Column helpers on text."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad_id(c: Column, width: int = 8) -> Column:
    """Left-pad an identifier with zeros to a width; longer ones stay as they are, so that no two meet."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def blank_to_null(c: Column, *blanks: str) -> Column:
    """NULL where the text equals one of ``blanks`` (the empty string by default)."""
    for blank in blanks or ("",):
        c = F.nullif(c, F.lit(blank))
    return c


def strip_space(c: Column) -> Column:
    """Drop leading and trailing white space of any kind."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def strip_nul(c: Column) -> Column:
    """Drop 0x00 characters. A search for one character; text without it is passed on as it is."""
    return F.replace(c, F.lit("\x00"), F.lit(""))


def nul_count(c: Column) -> Column:
    """Number of 0x00 characters; 0 for NULL."""
    return F.coalesce(F.length(c) - F.length(strip_nul(c)), F.lit(0)).cast("bigint")


def code_prefix(code: Column, n: int = 2, pad: int | None = None) -> Column:
    """First ``n`` digits of a numeric code.

    A code stored as a number has lost its leading zeros; ``pad`` puts them back first.
    """
    digits = code.cast("string")
    if pad is not None:
        digits = pad_id(digits, pad)
    return F.substring(digits, 1, n)


def has_prefix(code: Column, prefixes: Sequence[str], n: int = 2) -> Column:
    """True where :func:`code_prefix` of a whole-number code is one of ``prefixes``.

    Codes that begin with given digits form one range of numbers for each length, so the test is a list
    of comparisons that reaches the scan, and no row is turned into text. A prefix shorter than ``n`` is
    that very code. Prefixes that are no such digits match nothing, or are compared as text if negative.
    """
    tests = []
    for prefix in dict.fromkeys(prefixes):
        if not re.fullmatch("[0-9]+", prefix) or len(prefix) > n or prefix != str(int(prefix)):
            if prefix.startswith("-"):
                tests.append(code_prefix(code, n) == prefix)
        elif len(prefix) < n:
            tests.append(code == int(prefix))
        else:
            for digits in range(19 - len(prefix) + 1):
                low = int(prefix) * 10**digits
                high = min(low + 10**digits - 1, 2**63 - 1)
                if low <= high:
                    tests.append((code >= low) & (code <= high))
    return reduce(or_, tests) if tests else F.lit(False)


def truncate(c: Column, n: int = 40) -> Column:
    return F.substring(c, 1, n)


def thousands(c: Column) -> Column:
    """Whole number with dots between thousands: 1234567 -> 1.234.567."""
    return F.translate(F.format_number(c, 0), ",", ".")


def money(c: Column, decimals: int = 2) -> Column:
    """Amount with decimal comma: 1234567.8 -> 1.234.567,80."""
    return F.translate(F.format_number(c, decimals), ",.", ".,")
