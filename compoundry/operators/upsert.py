"""Upserts (M01-M16): a target, a source with one row per key, and one rule per column.

Files hold no keys, so an upsert is a join and a new version of the table. Two shapes:

* ``upsert`` - one full outer join on the key; right when a large part of the target changes.
* ``upsert(..., delta=True)`` - left join for the updates plus anti-join for the inserts; right when
  the source is small, as Catalyst may then broadcast the source (a full outer join never may) and
  the target is not shuffled at all.
* ``insert_only`` - anti-join on the key columns; the wide target rows pass through unshuffled.

Keys follow SQL conflict rules: a row with NULL in its key never collides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Conflict rules per table. ``keep`` leaves the stored value, ``new`` takes the incoming
# one, ``coalesce_new`` takes it unless NULL, ``now`` stamps inserted and updated rows.
_REGISTRY_FACTS = [
    "canonical_name", "iupac_name", "formula", "mol_weight", "canonical_smiles", "inchi", "inchikey",
]
_REGISTRY_TIMES = {"created_at": "keep", "updated_at": "now"}
REGISTRY_KEYS = ["source", "external_id"]
REGISTRY_FROM_PROPERTIES = {  # M01
    "cid": "new", **dict.fromkeys(_REGISTRY_FACTS, "coalesce_new"), "synonyms": "nonempty_array",
    "properties": "coalesce_new", **_REGISTRY_TIMES,
}
REGISTRY_FROM_RESULTS = {  # M02
    "cid": "keep", **dict.fromkeys(_REGISTRY_FACTS, "coalesce_new"), "synonyms": "keep",
    "properties": "keep", **_REGISTRY_TIMES,
}
XREF_KEYS = ["product_id", "source", "external_id"]
XREF_FROM_RESULTS = {  # M04
    "cas": "coalesce_new", "match_confidence": "greatest", "properties_ref": "keep", "chem_id": "keep",
    "updated_at": "now",
}
XREF_FROM_DOCUMENTS = {  # M05
    "cas": "new", "match_confidence": "greatest", "properties_ref": "keep", "chem_id": "keep",
    "updated_at": "now",
}
XREF_FROM_STREAM = {  # M06
    "cas": "keep", "match_confidence": "keep", "properties_ref": "new", "chem_id": "keep",
    "updated_at": "now",
}
COMPOUND_KEYS = ["source", "external_id"]
COMPOUND_LATEST = {"query": "new", "properties": "new", **_REGISTRY_TIMES}  # M07
DOCUMENT_KEYS = ["file_sha256"]
DOCUMENT_BY_DIGEST = {"title": "new", "filename": "keep"}  # M09
PAGE_KEYS = ["doc_id", "page_no"]
PAGE_REPLACE = dict.fromkeys(["has_text", "ocr_used", "ocr_conf", "text"], "new")  # M10
SECTION_KEYS = ["doc_id", "section_no"]
SECTION_REPLACE = {"title": "coalesce_new", "text": "new"}  # M11
HAZARD_KEYS = ["doc_id", "code"]
HAZARD_LAST_STATEMENT = {"page_no": "keep", "section": "keep", "statement": "new"}  # M14
# insert-only tables: M03, M08, M12, M13
QUERY_KEYS = ["source_item_id", "query", "hint"]
ENTITY_KEYS = ["doc_id", "entity_type", "norm_value"]
COMPONENT_KEYS = ["doc_id", "cas_norm", "name_key"]


def _column(rule: str, old: Column, new: Column, matched: Column, inserted: Column, now: Column) -> Column:
    if rule == "now":
        return F.when(inserted | matched, now).otherwise(old)
    if rule == "keep":
        return F.when(inserted, new).otherwise(old)
    if rule == "new":
        return F.when(inserted | matched, new).otherwise(old)
    if rule == "coalesce_new":
        return F.coalesce(new, old)
    if rule == "greatest":
        return F.greatest(old, new)
    if rule == "nonempty_array":
        return F.when(F.size(new) > 0, new).otherwise(F.coalesce(old, new))
    raise ValueError(f"unknown rule {rule!r}")


def _aligned(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source columns in the types of the target; columns it does not have become NULL."""
    return source.select(
        *[
            (F.col(f.name) if f.name in source.columns else F.lit(None)).cast(f.dataType.simpleString()).alias(f.name)
            for f in target.schema.fields
        ]
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    rules: dict[str, str],
    now: Column | None = None,
    delta: bool = False,
) -> DataFrame:
    """The target after the upsert. ``source`` has at most one row per key (see ``reduce_latest``)."""
    stamp = now if now is not None else F.current_timestamp()
    src = _aligned(source, target)
    rest = [c for c in target.columns if c not in keys]
    t = target.select(*target.columns, F.lit(True).alias("_t"))
    s = src.select(*keys, *[F.col(c).alias("_s_" + c) for c in rest], F.lit(True).alias("_s"))

    def project(joined: DataFrame) -> DataFrame:
        matched = F.col("_t").isNotNull() & F.col("_s").isNotNull()
        inserted = F.col("_t").isNull()
        return joined.select(
            *[
                F.col(c) if c in keys
                else _column(
                    rules.get(c, "keep"), F.col(c), F.col("_s_" + c), matched, inserted, stamp
                ).cast(target.schema[c].dataType.simpleString()).alias(c)
                for c in target.columns
            ]
        )

    if not delta:
        return project(t.join(s, keys, "full_outer"))
    updated = project(t.join(s, keys, "left"))
    added = src.join(target.select(*keys), keys, "left_anti")
    for c in rest:
        if rules.get(c) == "now":
            added = added.withColumn(c, stamp.cast(target.schema[c].dataType.simpleString()))
    return updated.unionByName(added)


def insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Add source rows whose key is new (``ON CONFLICT DO NOTHING``); stored rows never change."""
    src = _aligned(source, target)
    return target.unionByName(src.join(target.select(*keys), keys, "left_anti"))


def reduce_latest(source: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One row per key: the one with the highest ``order``; combined before the shuffle."""
    rest = [c for c in source.columns if c not in keys]
    best = source.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col("_best")[c].alias(c) for c in source.columns])


def reduce_first(source: DataFrame, keys: list[str], order: Column) -> DataFrame:
    rest = [c for c in source.columns if c not in keys]
    best = source.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col("_best")[c].alias(c) for c in source.columns])


def hint_lowercase(log: DataFrame) -> DataFrame:
    """M16."""
    return log.withColumn("hint", F.lower("hint"))
