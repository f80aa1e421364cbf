"""Derive lookup queries from catalog items: J01, J04, J13, J19, A02, F27, M08, U01."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import patterns as P
from ..functions.cas import extract_cas_loose, is_cas_shaped
from ..functions.jsons import json_each_text
from ..functions.text import seed_hint, seed_query, strip_noise_name, title_case
from .matching import match_patterns, pattern_array, pattern_rows
from .upsert import insert_only

ALIAS_ROWS = [dict(zip(("pattern", "replacement", "hint", "note"), r)) for r in P.ALIASES]

# Order in which a query may be found; an earlier branch wins. The low 20 bits hold the match position.
BRANCHES = ["cas", "name", "sku", "raw", "alias", "chemical_name", "wide_name"]
_BRANCH_BITS = 20


def linked_ids(xref: DataFrame, source: str = P.SOURCE_COMPOUND) -> DataFrame:
    """Products with a link; distinct first, so that a product with many links is one row in the join."""
    return xref.filter(F.col("source") == source).select(F.col("product_id").alias("source_item_id")).distinct()


def unlinked(items: DataFrame, xref: DataFrame) -> DataFrame:
    """J01."""
    return items.join(linked_ids(xref), "source_item_id", "left_anti")


def scope_join(scope: DataFrame, items: DataFrame) -> DataFrame:
    """Items inside a scope of item ids."""
    return items.join(scope.select("source_item_id").distinct(), "source_item_id", "left_semi")


def with_raw(items: DataFrame, staging: DataFrame) -> DataFrame:
    """Items next to the staged source row they came from."""
    return items.join(staging.select(F.col("id").alias("source_item_id"), "raw"), "source_item_id", "left")


def alias_match(items: DataFrame, alias: DataFrame | list[dict] | None = None) -> DataFrame:
    """Everyday names to what should be looked up."""
    lowered = items.select("source_item_id", F.lower("name").alias("_text"))
    matched = match_patterns(lowered, "_text", ALIAS_ROWS if alias is None else alias, ["replacement", "hint"])
    return matched.select("source_item_id", F.col("replacement").alias("query"), "hint")


def with_fixed_aliases(alias: DataFrame) -> DataFrame:
    """M08 on the stored aliases: fixed ones whose pattern is new are added, after the stored ones where these have a
    ``position``; stored rows never change."""
    last = alias.agg(F.max("position")).first()[0] or 0 if "position" in alias.columns else 0
    fixed = alias.sparkSession.createDataFrame(
        [(r["pattern"], r["replacement"], r["hint"], r["note"], last + i) for i, r in enumerate(ALIAS_ROWS, 1)],
        "pattern string, replacement string, hint string, note string, position long")
    return insert_only(alias, fixed, ["pattern"])


def lateral_extract(df: DataFrame, column: str) -> DataFrame:
    """One row per number found in a text column."""
    return df.select("source_item_id", F.posexplode(extract_cas_loose(F.col(column))).alias("match_pos", "query"))


def cas_from_raw(items: DataFrame) -> DataFrame:
    """Per item, the smallest of the first numbers found in its raw values."""
    first = F.nullif(F.regexp_extract(F.lower("value"), P.CAS_TOKEN, 0), F.lit(""))
    return (
        json_each_text(items.select("source_item_id", "raw"), "raw")
        .select("source_item_id", first.alias("cas_in_raw"))
        .filter(F.col("cas_in_raw").isNotNull())
        .groupBy("source_item_id")
        .agg(F.min("cas_in_raw").alias("cas_in_raw"))
    )


def _branch(name: str, position: Column | int = 0) -> Column:
    base = F.lit((BRANCHES.index(name) + 1) << _BRANCH_BITS).cast("long")
    return base + (position if isinstance(position, Column) else F.lit(position))


def _entry(query: Column, hint: Column | str, seq: Column) -> Column:
    h = hint if isinstance(hint, Column) else F.lit(hint)
    return F.struct(query.alias("query"), h.alias("hint"), seq.alias("seq"))


def _when(condition: Column, entry: Column) -> Column:
    return F.filter(F.array(F.when(condition, entry)), lambda x: x.isNotNull())


def _found(column: str, branch: str) -> Column:
    return F.transform(
        F.coalesce(extract_cas_loose(F.col(column)), F.array().cast("array<string>")),
        lambda q, i: _entry(q, "cas", _branch(branch, i)),
    )


def build_seed(
    items: DataFrame,
    staging: DataFrame | None = None,
    alias: DataFrame | list[dict] | None = None,
    scope: DataFrame | None = None,
    wide: bool = False,
) -> DataFrame:
    """All lookup queries of the items, one row per (item, query, hint), the earliest branch kept.

    The branches are arrays built side by side in one projection, so items are read once and nothing
    is joined per branch; the only shuffle is the de-duplication, which combines before it.
    ``items`` carries ``raw``, or ``staging`` brings it.
    """
    rows = items if scope is None else scope_join(scope, items)
    if staging is not None:
        rows = with_raw(rows, staging)
    raw_firsts = F.transform(
        F.map_values(F.from_json("raw", "map<string,string>")),
        lambda v: F.nullif(F.regexp_extract(F.lower(v), P.CAS_TOKEN, 0), F.lit("")),
    )
    base = rows.select(
        "source_item_id", "sku", "name", "cas",
        F.array_min(F.filter(raw_firsts, lambda v: v.isNotNull())).alias("_raw_cas"),
        F.lower("name").alias("_lower"),
        strip_noise_name(F.col("name")).alias("_clean"),
    )
    raw_cas = F.col("_raw_cas")
    named = (F.col("name") != "") & (F.length("_clean") >= 3)
    titled = title_case(F.col("_clean"))
    branches = [
        _when(is_cas_shaped(F.col("cas")), _entry(F.col("cas"), "cas", _branch("cas"))),
        _found("name", "name"),
        _found("sku", "sku"),
        _when(raw_cas.isNotNull(), _entry(raw_cas, "cas", _branch("raw"))),
    ]
    chemical = _when(
        named & F.col("_clean").rlike("(?i)" + P.CHEMICAL_WORDS), _entry(titled, "name", _branch("chemical_name"))
    )
    late = [chemical] + ([_when(named, _entry(titled, "name", _branch("wide_name")))] if wide else [])
    rows_alias = pattern_rows(ALIAS_ROWS if alias is None else alias, ["replacement", "hint"])
    if rows_alias:
        hits = pattern_array(F.col("_lower"), rows_alias, ["replacement", "hint"])
        branches.append(F.transform(hits, lambda a, i: _entry(a["replacement"], a["hint"], _branch("alias", i))))
    flat = base.select("source_item_id", F.explode(F.concat(*branches, *late)).alias("q")).select(
        "source_item_id", "q.query", "q.hint", "q.seq"
    )
    return (
        flat.groupBy("source_item_id", "query", "hint")
        .agg(F.min("seq").alias("seq"))
        .withColumn("branch_no", F.shiftright("seq", _BRANCH_BITS).cast("int"))
    )


def seed_query_hint(staging: DataFrame) -> DataFrame:
    """the first query of each staged item."""
    query = seed_query(F.col("cas"), F.col("name"))
    return staging.select(F.col("id").alias("source_item_id"), query.alias("query"), seed_hint(F.col("cas")).alias("hint")).filter(
        F.col("query").isNotNull()
    )
