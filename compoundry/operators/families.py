"""Product families by pattern: J05, J06, M08."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import patterns as P
from ..functions.text import strip_noise_name
from .matching import match_patterns
from .registry import chem_id
from .skew import split_hot_join
from .upsert import insert_only

FAMILY_ROWS = [dict(zip(("family_id", "name", "pattern", "note"), r)) for r in P.FAMILIES]
_PAIR = ["product_id", "family_id"]


def with_fixed_families(family: DataFrame) -> DataFrame:
    """M08 on the stored families: fixed ones whose name is new are added, with ids after the greatest that is stored.

    Stored rows stay, also where a fixed one has the same name with another pattern.
    """
    names = family.select("name").distinct()
    fixed = family.sparkSession.createDataFrame(
        [(i, r["name"], r["pattern"], r["note"]) for i, r in enumerate(FAMILY_ROWS)], "position int, name string, pattern string, note string")
    new = fixed.join(names, "name", "left_anti")
    last = family.agg(F.max("family_id")).first()[0] or 0
    number = F.row_number().over(W.orderBy("position")) + F.lit(last)  # the fixed rows are a few
    return insert_only(family, new.withColumn("family_id", number), ["name"])


def family_by_name(
    items: DataFrame, existing: DataFrame, family: DataFrame | list[dict] | None = None
) -> DataFrame:
    """Families found in the cleaned product name, without pairs that exist."""
    named = items.select(F.col("source_item_id").alias("product_id"), strip_noise_name(F.col("name")).alias("_text"))
    matched = match_patterns(named, "_text", FAMILY_ROWS if family is None else family, ["family_id"], "(?i)")
    new = matched.select(*_PAIR).join(existing.select(*_PAIR), _PAIR, "left_anti")
    return new.withColumn("confidence", F.lit(P.CONF_FAMILY_NAME))


def family_by_registry(
    items: DataFrame,
    xref: DataFrame,
    registry: DataFrame,
    assigned: DataFrame,
    family: DataFrame | list[dict] | None = None,
) -> DataFrame:
    """Families found in the names of the linked compound, only pairs not yet assigned.

    Patterns run once per compound, before the join, not once per link.
    """
    named = registry.select(
        chem_id(F.col("source"), F.col("external_id")).alias("chem_id"),
        F.coalesce(F.lower("iupac_name"), F.lower("canonical_name")).alias("_text"),
    )
    matched = match_patterns(named, "_text", FAMILY_ROWS if family is None else family, ["family_id"], "(?i)")
    links = xref.filter((F.col("source") == P.SOURCE_COMPOUND) & F.col("chem_id").isNotNull()).select(
        "product_id", "chem_id"
    )
    products = items.select(F.col("source_item_id").alias("product_id"))
    pairs = split_hot_join(links, matched.select("chem_id", "family_id"), ["chem_id"]).select(*_PAIR).distinct()
    # distinct pairs: a product has at most one row per family here, however many links it has
    new = pairs.join(products, "product_id", "left_semi").join(assigned.select(*_PAIR), _PAIR, "left_anti")
    return new.withColumn("confidence", F.lit(P.CONF_FAMILY_REGISTRY))
