"""Compound registry and product links: J07, J08, J16, J20, A09, and the sources of M01, M03, M05-M07."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import patterns as P
from ..functions.jsons import json_text, json_text_array
from .skew import split_hot_join
from .upsert import XREF_KEYS, reduce_latest


def chem_id(source: Column, external_id: Column) -> Column:
    """Registry id: the natural key as text. No sequence is needed, and every run gives the same id."""
    return F.concat(source, F.lit(":"), external_id)


def registry_from_properties(compounds: DataFrame) -> DataFrame:
    """M01 source: registry rows from the stored JSON of looked-up compounds."""
    p = F.col("properties")
    return compounds.filter(F.col("source") == P.SOURCE_COMPOUND).select(
        "source",
        "external_id",
        json_text(p, "CID", "bigint").alias("cid"),
        json_text(p, "Title").alias("canonical_name"),
        json_text(p, "IUPACName").alias("iupac_name"),
        json_text(p, "MolecularFormula").alias("formula"),
        json_text(p, "MolecularWeight", "decimal(18,6)").alias("mol_weight"),
        json_text(p, "CanonicalSMILES").alias("canonical_smiles"),
        json_text(p, "InChI").alias("inchi"),
        json_text(p, "InChIKey").alias("inchikey"),
        json_text_array(p, "Synonyms").alias("synonyms"),
        p.alias("properties"),
    )


def registry_for_numbers(entities: DataFrame) -> DataFrame:
    """M03 source: one registry row per number found in documents."""
    return distinct_cas(entities).select(F.lit("cas").alias("source"), F.col("cas").alias("external_id"))


def distinct_cas(entities: DataFrame) -> DataFrame:
    """Numbers found in documents."""
    return (
        entities.filter((F.col("entity_type") == "CAS") & F.col("norm_value").isNotNull())
        .select(F.col("norm_value").alias("cas"))
        .distinct()
    )


def distinct_doc_cas(docs: DataFrame, entities: DataFrame) -> DataFrame:
    """(product, number) pairs of documents that belong to a product.

    Pairs are made distinct per document first, so a document full of repeats is small in the join.
    """
    found = (
        entities.filter((F.col("entity_type") == "CAS") & F.col("norm_value").isNotNull())
        .select("doc_id", F.col("norm_value").alias("cas"))
        .distinct()
    )
    owned = docs.filter(F.col("product_id").isNotNull()).select("doc_id", "product_id")
    return found.join(owned, "doc_id").select("product_id", "cas").distinct()


def xref_from_documents(docs: DataFrame, entities: DataFrame) -> DataFrame:
    """M05 source."""
    return distinct_doc_cas(docs, entities).select(
        "product_id",
        F.lit("cas").alias("source"),
        F.col("cas").alias("external_id"),
        "cas",
        F.lit(P.CONF_DOCUMENT).alias("match_confidence"),
    )


def link_registry(xref: DataFrame, registry: DataFrame, source: str, now: Column | None = None) -> DataFrame:
    """Set ``chem_id`` on the links of ``source`` whose compound is registered, where it differs.

    A compound may carry a third of all links; its rows are spread over several tasks.
    """
    stamp = now if now is not None else F.current_timestamp()
    ids = registry.filter(F.col("source") == source).select(
        "source", "external_id", chem_id(F.col("source"), F.col("external_id")).alias("_new")
    )
    joined = split_hot_join(xref, ids, ["source", "external_id"], "left")
    changed = F.col("_new").isNotNull() & ~F.col("chem_id").eqNullSafe(F.col("_new"))
    out = joined.withColumn("_changed", changed)
    cols = []
    for c in xref.columns:
        if c == "chem_id":
            cols.append(F.when(F.col("_changed"), F.col("_new")).otherwise(F.col(c)).alias(c))
        elif c == "updated_at":
            cols.append(F.when(F.col("_changed"), stamp).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return out.select(*cols)


def product_properties(items: DataFrame, xref: DataFrame, registry: DataFrame) -> DataFrame:
    """Linked products next to what the registry knows of the compound."""
    links = xref.filter(F.col("source") == P.SOURCE_COMPOUND).select(
        "product_id", F.col("external_id").alias("pubchem_cid"), "chem_id"
    )
    facts = registry.select(
        chem_id(F.col("source"), F.col("external_id")).alias("chem_id"),
        "formula", "mol_weight", "iupac_name", "canonical_smiles", "inchikey",
    )
    products = items.select(
        F.col("source_item_id").alias("product_id"), "sku", "name", F.col("cas").alias("product_cas")
    )
    owned = links.join(products, "product_id")  # a product has few links: no counting of keys
    return split_hot_join(owned, facts, ["chem_id"], "left", count_from=links).select(
        "product_id", "sku", "name", "product_cas", "pubchem_cid",
        "formula", "mol_weight", "iupac_name", "canonical_smiles", "inchikey",
    )


def relink_to_compound(xref: DataFrame, registry: DataFrame, now: Column | None = None) -> DataFrame:
    """Number links whose registry row names a known compound become compound links.

    A rewritten link may meet an existing one; the higher confidence stays, then the stored one.
    """
    stamp = now if now is not None else F.current_timestamp()
    target = registry.filter((F.col("source") == P.SOURCE_COMPOUND) & F.col("cid").isNotNull()).groupBy(
        F.col("cid").cast("string").alias("_cid")
    ).agg(F.min("external_id").alias("_ext"))
    known = (
        registry.filter(F.col("source") == "cas")
        .select(
            F.lit("cas").alias("source"),
            chem_id(F.col("source"), F.col("external_id")).alias("chem_id"),
            F.get_json_object("properties", "$.cid").alias("_cid"),
        )
        .filter(F.col("_cid").isNotNull())
        .join(target, "_cid")
        .select("source", "chem_id", "_ext")
    )
    joined = split_hot_join(xref, known, ["source", "chem_id"], "left")
    moved = F.col("_ext").isNotNull()
    rewritten = joined.select(
        *[
            F.when(moved, P.SOURCE_COMPOUND).otherwise(F.col(c)).alias(c) if c == "source"
            else F.coalesce("_ext", c).alias(c) if c == "external_id"
            else F.when(moved, stamp).otherwise(F.col(c)).alias(c) if c == "updated_at"
            else F.col(c)
            for c in xref.columns
        ],
        moved.alias("_moved"),
    )
    order = F.struct(F.coalesce("match_confidence", F.lit(-1.0)), ~F.col("_moved"), F.coalesce("chem_id", F.lit("")))
    return reduce_latest(rewritten, XREF_KEYS, order).select(*xref.columns)


def named_cross(a: DataFrame, b: DataFrame, a_filter: Column, b_filter: Column, columns: list[Column]) -> DataFrame:
    """Pair the rows that two name filters pick.

    The filters go first, and each side is spread over its own shares of a grid with as many cells as there are
    shuffle partitions, so that neither side is gathered in one task: every pair meets in exactly one cell.
    """
    n = max(2, math.ceil(math.sqrt(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    left = a.filter(a_filter).withColumn("_r", F.pmod(F.xxhash64(*a.columns), F.lit(n))).withColumn(
        "_c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    )
    right = b.filter(b_filter).withColumn("_c", F.pmod(F.xxhash64(*b.columns), F.lit(n))).withColumn(
        "_r", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    )
    return left.join(right, ["_r", "_c"]).select(*columns)


def synonyms_agg(compounds: DataFrame) -> DataFrame:
    """Synonyms of each compound as an array; read inside the row, no grouping."""
    return compounds.select("source", "external_id", json_text_array(F.col("properties"), "Synonyms").alias("synonyms"))
