"""Keyword patterns (P10, P10b) and the probe token used to turn the regex join
into an equi-join.

Word characters follow Python's ``\\w`` on ``str`` patterns, which is letters,
numbers and underscore; in Java regex that is ``[\\p{L}\\p{N}_]`` (plain Java
``\\w`` is ASCII only and ``(?U)\\w`` adds marks and connectors).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word class and the bounds of a keyword match.
WORD_CLASS = r"[\p{L}\p{N}_]"
NON_WORD_RUN = r"[^\p{L}\p{N}_]+"
WORD_RUN = r"[\p{L}\p{N}_]+"
LEFT_BOUND = r"(?<![\p{L}\p{N}_])"
RIGHT_BOUND = r"(?![\p{L}\p{N}_])"
CASE_FLAGS = "(?iu)"


def quote_literal(kw: Column) -> Column:
    """Java-regex escape of a keyword column (``\\Q..\\E`` with ``\\E`` split)."""
    return F.concat(F.lit(r"\Q"), F.replace(kw, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def keyword_pattern(kw: Column) -> Column:
    """P10: the escaped keyword, not preceded or followed by a word character,
    case-insensitive."""
    return F.concat(F.lit(CASE_FLAGS + LEFT_BOUND), quote_literal(kw), F.lit(RIGHT_BOUND))


# Lower-case letters that Python's re.IGNORECASE treats as equal
# to another letter (CPython's case-equivalence table), each mapped to that
# letter: dotless i, long s, micro sign, Greek prosgegrammeni, iota and upsilon
# with dialytika and oxia, and the Greek beta, lunate epsilon, theta, kappa,
# pi, rho, final sigma and phi symbols, long s with dot above, long s t.
CASE_EQUIVALENT_FROM = "\u0131\u017f\u00b5\u1fbe\u1fd3\u1fe3\u03d0\u03f5\u03d1\u03f0\u03d6\u03f1\u03c2\u03d5\u1e9b\ufb05"
CASE_EQUIVALENT_TO = "\u0069\u0073\u03bc\u03b9\u0390\u03b0\u03b2\u03b5\u03b8\u03ba\u03c0\u03c1\u03c3\u03c6\u1e61\ufb06"


def fold(text: Column) -> Column:
    """Case-fold for token comparison: capital I with dot above first becomes
    ``i`` (its full lower case is two characters), then ``lower`` and the
    equivalences above, so equal folded tokens are exactly the tokens Python's
    case-insensitive matching treats as equal. The character mapping runs
    only on texts that hold one of the rare characters (capital sigma is
    included because lower-casing can turn it into a final sigma), which are
    looked for in texts that are not plain ASCII."""
    full = F.translate(F.lower(F.translate(text, "\u0130", "i")), CASE_EQUIVALENT_FROM, CASE_EQUIVALENT_TO)
    rare = (F.octet_length(text) > F.char_length(text)) & text.rlike("[" + CASE_EQUIVALENT_FROM + "\u0130\u03a3]")
    return F.when(rare, full).otherwise(F.lower(text))


def is_single_word(kw: Column) -> Column:
    """True when the keyword is exactly one word run: its hits are token counts."""
    return kw.rlike("^" + WORD_RUN + r"\z")


# Fixed value: Python's Unicode ``\b`` (a word/non-word transition).
WORD_BOUNDARY = (r"(?:(?<=[\p{L}\p{N}_])(?![\p{L}\p{N}_])"
                 r"|(?<![\p{L}\p{N}_])(?=[\p{L}\p{N}_]))")


def category_alternation(keywords: Column, escape: bool = False) -> Column:
    """One alternation per category, each keyword between ``\b`` bounds,
    keyword order is alternation priority, case-insensitive. Older generations
    did not escape keywords, so regex metacharacters stay live unless
    ``escape`` is set.

    When every keyword begins and ends with a word character, ``\b`` on each
    side is a plain look-behind/look-ahead and the bounds are factored out of
    the alternation (same matches, one boundary test per position)."""
    items = F.transform(keywords, quote_literal) if escape else keywords
    bounded = F.transform(items, lambda k: F.concat(F.lit(WORD_BOUNDARY), k, F.lit(WORD_BOUNDARY)))
    general = F.concat(F.lit(CASE_FLAGS), F.array_join(bounded, "|"))
    # Word characters at both ends and no regex syntax in between.
    plain = "^" + WORD_CLASS + r"(?:[\p{L}\p{N}_ &',/-]*" + WORD_CLASS + r")?\z"
    word_edges = F.forall(keywords, lambda k: k.rlike(plain))
    # A character that begins no keyword is passed over by one look at it. Java's classes fold ASCII
    # letters as its literals do (not all others), so any other first character leaves this out.
    ascii_first = (F.size(keywords) > 0) & F.forall(keywords, lambda k: k.rlike("^[A-Za-z0-9_]"))
    firsts = F.array_join(F.array_sort(F.array_distinct(F.transform(keywords, lambda k: F.lower(F.left(k, F.lit(1)))))), "")
    ahead = F.when(ascii_first, F.concat(F.lit("(?=["), firsts, F.lit("])"))).otherwise(F.lit(""))
    factored = F.concat(F.lit(CASE_FLAGS), ahead, F.lit(LEFT_BOUND + "(?:"), F.array_join(items, "|"),
                        F.lit(")" + RIGHT_BOUND))
    return F.when(word_edges, factored).otherwise(general)
