"""Spreadsheet cell helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def column_letters(col: Column | str) -> Column:
    """1-based column ordinal to spreadsheet letters (A, Z, AA, AZ, BA, ZZ,
    AAA ... XFD). The original is wrong at multiples of 26 above 26 and above
    702; this is the correct bijective base-26 form."""
    n = _c(col).cast("int")
    two_hi = F.floor((n - 1) / 26).cast("int")
    two_lo = ((n - 1) % 26).cast("int")
    m = n - 703
    three_a = F.floor(m / 676).cast("int")
    three_b = (F.floor(m / 26) % 26).cast("int")
    three_c = (m % 26).cast("int")
    return (F.when(n <= 26, F.char(n + 64))
             .when(n <= 702, F.concat(F.char(two_hi + 64), F.char(two_lo + 65)))
             .otherwise(F.concat(F.char(three_a + 65), F.char(three_b + 65), F.char(three_c + 65))))


def cell_address(col: Column | str, row: Column | str) -> Column:
    """``<letters><row>``."""
    return F.concat(column_letters(col), _c(row).cast("string"))


def qualified_location(sheet: Column | str, col: Column | str, row: Column | str) -> Column:
    """``<sheet>: <address>``."""
    return F.concat(_c(sheet), F.lit(": "), cell_address(col, row))
