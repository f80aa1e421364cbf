"""Enrichment of requests from a compound reference table: J18, in place of a network call."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cas import is_cas_shaped
from ..functions.text import strip_ws
from ..operators.skew import split_hot_join
from ..operators.upsert import reduce_first
from ..sources.versions import Versions

INDEX = "lookup_index"
INDEX_SCHEMA = "kind string, key string, cid bigint, molecular_formula string, molecular_weight string, iupac_name string"
FACTS = ["cid", "molecular_formula", "molecular_weight", "iupac_name"]


def lookup_index(compounds: DataFrame) -> DataFrame:
    """One row per (kind, key): names folded to lower case, and registry numbers. Lowest compound id wins.

    Store it bucketed or sorted by ``key`` when it is large; it changes only when the reference does.
    """
    keys = F.array(
        F.when(strip_ws(F.col("title")) != "", F.struct(F.lit("name").alias("kind"), F.lower(strip_ws(F.col("title"))).alias("key"))),
        F.when(is_cas_shaped(F.col("cas")), F.struct(F.lit("cas").alias("kind"), F.col("cas").alias("key"))),
    )
    rows = compounds.filter(F.col("cid").isNotNull()).select(F.explode(keys).alias("k"), *FACTS)
    flat = rows.filter(F.col("k").isNotNull()).select("k.kind", "k.key", *FACTS)
    order = F.struct("cid", *[F.struct(F.col(c).isNull(), F.col(c)) for c in FACTS[1:]])
    return reduce_first(flat, ["kind", "key"], order)


def publish_index(store: Versions, compounds: DataFrame) -> int:
    """The next version of the lookup index, for workers that run on (``current_index``). Rows lie in ranges of ``key``,
    so that a reader with few keys can skip row groups."""
    index = lookup_index(compounds)
    return store.publish({INDEX: index.repartitionByRange("key", "kind").sortWithinPartitions("key", "kind")})


def current_index(store: Versions) -> Callable[[], DataFrame]:
    """The index as a worker takes it: asked for by every micro-batch, which then stays with the version it found. Before
    the first publication the index is empty. A batch that is replayed may find a newer version."""
    def read() -> DataFrame:
        found = store.table(INDEX)
        return store.spark.createDataFrame([], INDEX_SCHEMA) if found is None else found

    return read


def enrich_lookup(requests: DataFrame, index: DataFrame, column: str = "query") -> DataFrame:
    """Facts of the compound found by number (when the query is one), else by name.

    Rows with NULL in ``column`` ask nothing and get no facts.

    Distinct query texts meet the index first; in a small batch that side is broadcast, so the index is
    filtered where it lies and is not shuffled per batch. Repeats of a query get the result afterwards.
    """
    text = strip_ws(F.col(column))
    asked = requests.select(text.alias("_text")).filter(F.col("_text") != "").distinct()
    keys = asked.select(
        "_text",
        F.explode(
            F.array(
                F.struct(F.lit("name").alias("kind"), F.lower("_text").alias("key")),
                F.struct(F.when(is_cas_shaped(F.col("_text")), "cas").alias("kind"), F.col("_text").alias("key")),
            )
        ).alias("k"),
    ).select("_text", "k.kind", "k.key")
    hits = (
        index.join(keys.filter(F.col("kind").isNotNull()), ["kind", "key"])
        .groupBy("_text")
        .agg(F.min_by(F.struct(*FACTS), F.when(F.col("kind") == "cas", 0).otherwise(1)).alias("_hit"))
    )
    return split_hot_join(requests.withColumn("_text", text), hits, ["_text"], "left").select(
        *requests.columns, *[F.col("_hit")[c].alias(c) for c in FACTS]
    )
