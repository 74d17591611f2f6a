"""Scalar text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Literal two-character sequences the extractors leave behind.
EXTRACTION_DEBRIS = ["\\r", "\\n", "\\x", "0c"]


def cleanup_extraction(text: Column | str) -> Column:
    """Replace the literal debris sequences by a space (note: also turns
    ``100cm`` into ``10 m``, as the original does)."""
    out = _c(text)
    for s in EXTRACTION_DEBRIS:
        out = F.replace(out, F.lit(s), F.lit(" "))
    return out


def strip_special(text: Column | str, keep_dots: bool = False) -> Column:
    """Keep letters, digits and whitespace (and dots when asked)."""
    pattern = r"[^A-Za-z0-9\s.]+" if keep_dots else r"[^A-Za-z0-9\s]+"
    return F.regexp_replace(_c(text), pattern, "")


# Spellings the original treats as empty.
NULL_TOKENS = ["None", "NaN", "nan"]


def null_token(value: Column | str) -> Column:
    """Null, NaN and the null spellings become ''."""
    v = _c(value)
    return F.when(v.isNull() | v.isin(*NULL_TOKENS), F.lit("")).otherwise(v)


def is_nan(value: Column | str) -> Column:
    """Null or floating NaN."""
    v = _c(value)
    return v.isNull() | F.isnan(v)


# What Python's float() accepts once signs and other special
# characters have been stripped (digits, dots, whitespace and letters remain).
FLOAT_TEXT = (r"^\s*(?:[0-9]+\.?[0-9]*(?:[eE][0-9]+)?|\.[0-9]+(?:[eE][0-9]+)?"
              r"|(?i:inf|infinity|nan))\s*$")


def numeric_looking(value: Column | str) -> Column:
    """After stripping special characters (dots kept) the text parses as a
    float."""
    return strip_special(_c(value), keep_dots=True).rlike(FLOAT_TEXT)


def text_cell_keep(value: Column | str) -> Column:
    """a cell is matched only when it is present, has at least two
    characters and does not look numeric."""
    v = _c(value)
    return v.isNotNull() & (F.length(v) >= 2) & ~numeric_looking(v)


def keyword_count_label(keyword: Column | str, n: Column | str) -> Column:
    """``keyword(n), ``."""
    return F.concat(_c(keyword), F.lit("("), _c(n).cast("string"), F.lit("), "))


def yes_no(cond: Column) -> Column:
    """P18."""
    return F.when(cond, F.lit("Yes")).otherwise(F.lit("No"))


# Fixed value: the characters Python's ``str.strip`` takes off.
PYTHON_SPACE = r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def python_strip(text: Column | str) -> Column:
    """``str.strip()``: all white space off both ends, not only blanks."""
    return F.regexp_replace(_c(text), f"^{PYTHON_SPACE}+|{PYTHON_SPACE}+$", "")


def letter_count(text: Column | str) -> Column:
    """Strip white space, remove blanks, then clean up; the blanks that the
    cleanup puts in count."""
    return F.length(cleanup_extraction(F.replace(python_strip(text), F.lit(" "), F.lit(""))))
