"""Safety-sheet line functions: F09-F14."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import patterns as P


_NUMBER = r"[0-9]+(?:\.[0-9]+)?"


def parse_concentration(c: Column) -> Column:
    """``a - b %`` gives (a, b, %), ``x %`` gives (x, x, %), anything else NULLs.

    The whole expression is found once; its first and last number are the bounds.
    """
    found = F.when(c.contains("%"), F.regexp_extract(c, P.CONCENTRATION, 0))
    numbers = F.regexp_extract_all(found, F.lit(_NUMBER), F.lit(0))
    low, high = F.get(numbers, F.lit(0)), F.try_element_at(numbers, F.lit(-1))
    return F.struct(
        low.cast("double").alias("low"), high.cast("double").alias("high"), F.when(low.isNotNull(), "%").alias("unit")
    )


def section_tag(c: Column) -> Column:
    """the first ``SECTION n`` in a line, upper-cased."""
    return F.upper(F.nullif(F.regexp_extract(c, P.SECTION_TAG, 0), F.lit("")))


def _where(c: Column, may: Column, found: Column) -> Column:
    """``found``, or an empty array where ``may``, which costs less than a pattern, tells that there is nothing."""
    return F.when(c.isNull() | may, found).otherwise(F.array().cast("array<string>"))


def h_codes(c: Column) -> Column:
    """F11."""
    return _where(c, c.contains("H"), F.regexp_extract_all(c, F.lit(P.H_CODE), F.lit(0)))


def p_codes(c: Column) -> Column:
    """F12."""
    return _where(c, c.contains("P"), F.regexp_extract_all(c, F.lit(P.P_CODE), F.lit(0)))


def signal_words(c: Column) -> Column:
    """F13."""
    lower = F.lower(c)
    found = F.transform(F.regexp_extract_all(c, F.lit(P.SIGNAL_WORD), F.lit(1)), F.upper)
    return _where(c, lower.contains("danger") | lower.contains("warning"), found)


def component_name(line: Column, cas: Column) -> Column:
    """the text before the first occurrence of the number, without separators at its ends."""
    before = F.call_function("substring_index", line, cas, F.lit(1))
    return F.regexp_replace(before, "^" + P.NAME_EDGE_CHARS + "|" + P.NAME_EDGE_CHARS + r"\z", "")
