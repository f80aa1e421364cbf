"""Trigram similarity: F15.

Words are runs of letters and digits; each is padded with two blanks before and one after. All
words of a text are laid out in one padded string, and the overlapping three-character windows
are read with one zero-width pattern. Windows that end in two blanks lie between words.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WINDOW = r"(?=(..[^ ]|.[^ ] ))(?![\uDC00-\uDFFF])"


def trigrams(c: Column) -> Column:
    """Distinct trigrams of a text."""
    words = F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))
    padded = F.concat(F.lit("  "), F.regexp_replace(words, " ", "   "), F.lit(" "))
    grams = F.regexp_extract_all(padded, F.lit(_WINDOW), F.lit(1))
    return F.when(words == "", F.array().cast("array<string>")).otherwise(F.array_distinct(grams))


def packed_trigrams(c: Column) -> Column:
    """Trigrams as sorted longs (three code points of 21 bits): compact, and still exact."""

    def code(g: Column, i: int) -> Column:
        return F.ascii(F.substring(g, i, 1)).cast("long")

    return F.array_sort(
        F.transform(
            trigrams(c),
            lambda g: F.shiftleft(code(g, 1), 42) + F.shiftleft(code(g, 2), 21) + code(g, 3),
        )
    )


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all elements of two sets; 0 when both are empty."""
    shared = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - shared
    return F.when(total > 0, shared.cast("double") / total).when(total == 0, F.lit(0.0))


def trigram_similarity(a: Column, b: Column) -> Column:
    """0..1; NULL when either side is NULL."""
    return F.when(a.isNotNull() & b.isNotNull(), jaccard(trigrams(a), trigrams(b)))
