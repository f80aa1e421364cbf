"""Registry numbers: F03-F08."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import patterns as P


def is_cas_shaped(c: Column) -> Column:
    """the whole text has the shape of a registry number."""
    return c.rlike(P.CAS_SHAPE)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _with_digits(c: Column, body) -> Column:
    """``body`` of the digits of a text, which are taken once.

    A filter does not share common parts of an expression, and the digits occur many times in the check;
    bound to a lambda variable they are computed once wherever the optimizer moves the expression.
    """
    return F.get(F.transform(F.array(_digits(c)), body), F.lit(0))


def _hyphenated(d: Column) -> Column:
    n = F.length(d)
    return F.concat(
        d.substr(F.lit(1), n - 3), F.lit("-"), d.substr(n - 2, F.lit(2)), F.lit("-"), F.right(d, F.lit(1))
    )


def _check_digit_ok(d: Column) -> Column:
    """Weighted sum mod 10: the k-th digit before the last counts k times. The digits are taken from the number, which
    costs a small part of cutting them out of the text."""

    def ok(v: Column) -> Column:
        total = reduce(lambda a, b: a + b, [F.call_function("div", v, F.lit(10**k)) % 10 * k for k in range(1, 10)])
        return total % 10 == v % 10

    return F.get(F.transform(F.array(d.try_cast("bigint")), ok), F.lit(0))


def normalize_cas(c: Column) -> Column:
    """five to ten digits as ``a-bb-c``; no check of the last digit."""
    return _with_digits(c, lambda d: F.when(F.length(d).between(5, 10), _hyphenated(d)))


def cas_is_valid(c: Column) -> Column:
    """right length and right check digit; NULL counts as invalid."""
    return F.coalesce(_with_digits(c, lambda d: F.length(d).between(5, 10) & _check_digit_ok(d)), F.lit(False))


def cas_normalize(c: Column) -> Column:
    """F03 for valid numbers, NULL for others."""
    return _with_digits(c, lambda d: F.when(F.length(d).between(5, 10) & _check_digit_ok(d), _hyphenated(d)))


def cas_of_token(c: Column) -> Column:
    """F05 of what F07 and F08 find: such a token has its hyphens where F03 puts them, and five to ten digits, so only
    its check digit is looked at. For projections, which share the common parts of an expression."""
    v = F.replace(c, F.lit("-"), F.lit("")).try_cast("bigint")
    total = reduce(lambda a, b: a + b, [F.call_function("div", v, F.lit(10**k)) % 10 * k for k in range(1, 10)])
    return F.when(total % 10 == v % 10, c)


def _found_in(c: Column, pattern: str) -> Column:
    """All matches of a pattern of numbers; a text without a hyphen has none, which is told without a pattern."""
    none = F.array().cast("array<string>")
    return F.when(c.isNull() | c.contains("-"), F.regexp_extract_all(c, F.lit(pattern), F.lit(0))).otherwise(none)


def extract_cas_bounded(c: Column) -> Column:
    """every number-shaped token that does not touch other digits."""
    return _found_in(c, P.CAS_TOKEN_BOUNDED)


def extract_cas_loose(c: Column) -> Column:
    """every number-shaped token, even inside a longer run of digits."""
    return F.regexp_extract_all(c, F.lit(P.CAS_TOKEN), F.lit(0))
