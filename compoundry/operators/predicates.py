"""Row filters and checks of single rows: P01-P07."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import patterns as P
from ..functions.cas import is_cas_shaped
from ..functions.text import hint_normalize, strip_noise_name, strip_ws

_CHEMICAL = "(?i)" + P.CHEMICAL_WORDS


def wide_name(df: DataFrame) -> DataFrame:
    """Rows whose cleaned name has three characters or more; the cleaned name is added."""
    cleaned = df.withColumn("clean_name", strip_noise_name(F.col("name")))
    return cleaned.filter((F.col("name") != "") & (F.length("clean_name") >= 3))


def chemical_like(df: DataFrame) -> DataFrame:
    """P02, and the cleaned name holds a chemical word."""
    return wide_name(df).filter(F.col("clean_name").rlike(_CHEMICAL))


def include_exclude(df: DataFrame, include: str = P.CHEMICAL_WORDS, exclude: str = P.NON_CHEMICAL_WORDS) -> DataFrame:
    """Names that match ``include`` and not ``exclude``, any case."""
    name = F.col("name")
    return df.filter((name != "") & ~name.rlike("(?i)" + exclude) & name.rlike("(?i)" + include))


def request_error(query: Column, hint: Column) -> Column:
    """Why a request is refused, or NULL."""
    q = strip_ws(F.coalesce(query, F.lit("")))
    n = F.length(q)
    return (
        F.when(n == 0, "EMPTY_QUERY")
        .when((n < P.MIN_QUERY_LEN) | (n > P.MAX_QUERY_LEN), "BAD_QUERY_LENGTH")
        .when((hint_normalize(hint, "auto") == "cas") & ~is_cas_shaped(q), "INVALID_CAS")
    )


def validate_request(df: DataFrame) -> DataFrame:
    return df.withColumn("error", request_error(F.col("query"), F.col("hint")))


def quality_error(cid: Column, formula: Column, iupac_name: Column, weight: Column) -> Column:
    """Why a found compound is refused, or NULL. A missing or unreadable weight passes."""
    w = weight.try_cast("double")
    no_core = (F.coalesce(formula, F.lit("")) == "") & (F.coalesce(iupac_name, F.lit("")) == "")
    return (
        F.when(cid.isNull(), "NO_RESULT")
        .when(no_core, "MISSING_CORE_PROPS")
        .when(~w.between(P.MIN_WEIGHT, P.MAX_WEIGHT), "BAD_PROPERTY_RANGE")
    )


def quality_gate(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "error",
        quality_error(F.col("cid"), F.col("molecular_formula"), F.col("iupac_name"), F.col("molecular_weight")),
    )


def incomplete_rows(staged: DataFrame, n: int = 10) -> DataFrame:
    """A few staged rows that cannot be linked (no product or no compound), lowest keys first."""
    return (
        staged.filter(F.col("product_id").isNull() | F.col("pubchem_cid").isNull())
        .orderBy(*[F.col(c).asc_nulls_last() for c in staged.columns])
        .limit(n)
    )


def cas_items(items: DataFrame) -> DataFrame:
    """Items with a number-shaped cas, as queries."""
    return items.filter(is_cas_shaped(F.col("cas"))).select(
        "source_item_id", F.col("cas").alias("query"), F.lit("cas").alias("hint")
    )


def named_items(items: DataFrame) -> DataFrame:
    """Items with a name, as queries."""
    return items.filter(F.col("name") != "").select(
        "source_item_id", F.col("name").alias("query"), F.lit("name").alias("hint")
    )
