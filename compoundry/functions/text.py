"""Text clean-up: F01, F02, F18, F19, F23, F26 and the F25-F27 / F16 query helpers."""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import patterns as P
from .cas import is_cas_shaped

# What stands between white space at both ends; the end is looked for from behind, so blanks inside cost nothing.
_INNER = r"(?s)\A" + P.WS + r"*+(.*[^" + P.WS[1:] + ")?"


def strip_ws(c: Column) -> Column:
    """Remove whitespace of any kind at both ends (``trim`` removes spaces only)."""
    return F.regexp_extract(c, _INNER, 1)


def squeeze_ws(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, P.WS + "+", " "))


def normalize_name(c: Column) -> Column:
    """drop strengths, pack units, grade words and marks; keep the case."""
    return F.when(c != "", squeeze_ws(F.regexp_replace(c, P.NOISE, " ")))


def strip_noise_name(c: Column) -> Column:
    """the same on lower-cased text; used for seeding and families."""
    return normalize_name(F.lower(c))


def clean_text(c: Column, lower: bool = False) -> Column:
    """trimmed text, NULL when blank."""
    trimmed = F.nullif(F.trim(c), F.lit(""))
    return F.lower(trimmed) if lower else trimmed


def first_non_empty(*cols: Column) -> Column:
    """the first column that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def title_case(c: Column) -> Column:
    """upper-case the first character of every alphanumeric run (``F.initcap`` looks at spaces only)."""
    runs = F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"), F.lit(0))
    return F.array_join(
        F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30)))),
        "",
    )


def hint_normalize(c: Column, default: str) -> Column:
    """lower-cased hint; NULL or empty becomes ``default``."""
    return F.lower(F.coalesce(F.nullif(c, F.lit("")), F.lit(default)))


def priority_class(query: Column) -> Column:
    """1 registry number, 2 common name, 3 anything else."""
    return F.when(is_cas_shaped(query), 1).when(F.lower(query).isin(P.COMMON_NAMES), 2).otherwise(3)


def request_key(hint: Column, item_id: Column, query: Column, default_hint: str = "name") -> Column:
    """F16: ``pubchem|hint|item|query``; a missing item id is written ``None``."""
    return F.concat_ws(
        "|",
        F.lit(P.SOURCE_COMPOUND),
        hint_normalize(hint, default_hint),
        F.coalesce(item_id.cast("string"), F.lit("None")),
        F.lower(strip_ws(F.coalesce(query, F.lit("")))),
    )


def seed_query(cas: Column, name: Column) -> Column:
    """number when present, else the name."""
    return first_non_empty(cas, name)


def seed_hint(cas: Column) -> Column:
    return F.when(is_cas_shaped(cas), "cas").otherwise("name")
