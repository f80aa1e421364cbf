"""Near-duplicate documents by min-max hashing.

Under each permutation both the least and the largest hash of a document's shingles are kept, so half as many hashes
are computed for a signature of the same length. Four values make a band; sets that agree in a band are candidates.

1. Equal sets become one node first, so exact copies never meet in a band.
2. Of each band's bucket every member is compared with one hub only.
3. A set of which over 15 hundredths of the shingles occur in no other candidate can have no partner (at a
   similarity of 85 hundredths), nor can sets whose sizes and shared parts don't allow it; they are left out. What is
   then left of a bucket and doesn't lie in one component is compared pair by pair, each pair in the first band the
   two share. So no link among candidates is missed, and no bucket is cut or sampled.
4. Links are confirmed on full shingle sets; components follow in star rounds.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, durable, map_batches, may_match, strings
from .components import components
from .shingles import U, constants, least_and_most, shingle_set

SHINGLE = 5
#: Two documents are linked if 100 * common shingles >= PERCENT * shingles of either.
PERCENT = 85
#: 24 bands of 4 values: at a similarity of 0.85 a link is missed by all bands with a chance of 2e-8.
BANDS, ROWS = 24, 4
PERMUTATIONS = BANDS * ROWS // 2

_A, _B = constants(101, PERMUTATIONS), constants(202, PERMUTATIONS)


def bands(h: np.ndarray) -> np.ndarray:
    """The band hashes of a set: least and largest values alternate, ROWS of them to a band."""
    low, high = least_and_most(h, _A, _B)
    rows = np.stack([low, high], axis=1).reshape(BANDS, ROWS).astype("<u4")
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), seed=k) for k, r in enumerate(rows)], U).view(np.int64)


def set_key(h: np.ndarray) -> bytes:
    return xxhash.xxh128_digest(h.tobytes())


def signed(docs: DataFrame, doc_id: str, text: str, bands: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``set_key`` (null without shingles) and ``bands`` of every row."""
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        sets = [shingle_set(t, SHINGLE) for t in strings(batch, text)]
        return [
            pa.array([len(h) for h in sets], pa.int64()),
            pa.array([set_key(h) if len(h) else None for h in sets], pa.binary()),
            pa.array([bands(h) if len(h) else None for h in sets], pa.list_(pa.int64())),
        ]

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    return map_batches(rows, run, "n_shingles long, set_key binary, bands array<bigint>", ["doc_id", "text_hash"])


def full_sets(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``set_key`` and ``shingles`` of the wanted rows (``rep``, ``text_hash``, ``set_key``): one row for each set."""
    rows = docs.select(F.col(doc_id).alias("rep"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    rows = may_match(rows, F.xxhash64("rep", "text_hash"), wanted, F.xxhash64("rep", "text_hash"))
    chosen = rows.join(wanted, rows["rep"].eqNullSafe(wanted["rep"]) & (rows["text_hash"] == wanted["text_hash"])).select(
        "set_key", "text")

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([shingle_set(t, SHINGLE).view(np.int64) for t in strings(batch, "text")], pa.list_(pa.int64()))]

    return map_batches(chosen, run, "shingles array<bigint>", ["set_key"]).dropDuplicates(["set_key"])


def own_shingles(sets: DataFrame) -> DataFrame:
    """``set_key`` and ``own``: how many of a set's shingles no other of these sets has. Sets have a ``number`` each."""
    each = sets.select("number", F.explode("shingles").alias("h"))
    single = each.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min("number").alias("number")).filter("c = 1")
    return single.groupBy("number").agg(F.count(F.lit(1)).alias("own")).join(
        sets.select("number", "set_key"), "number").select("set_key", "own")


def with_own(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The members that can have a partner, with ``own``."""
    kept = members.drop("own").join(own_shingles(sets), "set_key", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    return kept.filter(100 * (F.col("n") - F.col("own")) >= percent * F.col("n"))


def possible(x: str, y: str, percent: int) -> Column:
    """Whether sizes and shared parts allow a link: no more than the smaller shared part can be common."""
    common = F.least(F.col(f"{x}.n") - F.col(f"{x}.own"), F.col(f"{y}.n") - F.col(f"{y}.own"))
    return 100 * common >= percent * (F.col(f"{x}.n") + F.col(f"{y}.n") - common)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets are similar enough."""
    left = sets.select(F.col("set_key").alias("a"), F.col("shingles").alias("_a"))
    right = sets.select(F.col("set_key").alias("b"), F.col("shingles").alias("_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("_a", "_b"))
    return both.filter(100 * common >= percent * (F.size("_a") + F.size("_b") - common)).select("a", "b")


def linked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT,
           band_hashes: Callable[[np.ndarray], np.ndarray] = bands) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``component_id`` (least id reachable), ``kept``, ``n_class`` (rows of
    the component) and ``survivor``, for every row. The survivor of a component is its least (id, text hash), nulls
    last; unlike ``kept`` it is one text also where near copies share an id or have none. A row linked with nothing is its own.

    Null and empty texts, and texts without words, have no shingles and are linked with nothing. Repeated rows get
    equal results. A row with a null id joins the component of its text, and is kept only where that has no other id.
    An empty table gives no rows; other columns are not read.
    """
    rows = durable(signed(docs, doc_id, text, band_hashes), "signed")
    nodes = rows.filter("set_key is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n"),
        F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")).alias("head"),
        F.min(F.struct("doc_id", "text_hash")).alias("source"), F.first("bands").alias("bands"))
    nodes = durable(nodes, "nodes")
    # Buckets by their hash first: of all band values only those that occur twice are joined with their sets.
    each = nodes.select("set_key", F.posexplode("bands").alias("band", "bucket"))
    hubs = each.groupBy(F.xxhash64("band", "bucket").alias("place")).agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    hubs = durable(hubs.select("place"), "hubs")
    near = may_match(each.withColumn("place", F.xxhash64("band", "bucket")), F.col("place"), hubs, F.col("place"))
    found = durable(near.join(hubs, "place", "left_semi").drop("place"), "members")
    discard(hubs)
    # The candidates' full sets, and what of them no other candidate has; once more among those that are left.
    asked = found.select("set_key").distinct()
    wanted = may_match(nodes, F.xxhash64("set_key"), asked, F.xxhash64("set_key")).join(asked, "set_key", "left_semi").select(
        "set_key", F.col("source.doc_id").alias("rep"), F.col("source.text_hash").alias("text_hash"), "n", "bands")
    wanted = durable(wanted, "wanted")
    sets = full_sets(docs, wanted.select("rep", "text_hash", "set_key"), doc_id, text)
    sets = durable(sets.withColumn("number", F.monotonically_increasing_id()), "sets")
    first = durable(with_own(wanted.select("set_key", "n", "bands"), sets, percent), "alive")
    alive = durable(with_own(first, sets.join(first.select("set_key"), "set_key", "left_semi"), percent), "alive")
    members = durable(found.select("band", "bucket", "set_key").join(alive.select("set_key", "n", "own"), "set_key"), "members")
    discard(found, wanted, first)
    # Each member against its hub, the one with the least share of its own.
    best = members.groupBy("band", "bucket").agg(
        F.min(F.struct((F.col("own") / F.col("n")).alias("share"), "set_key", "n", "own")).alias("hub"))
    best = best.select("band", "bucket", "hub.set_key", "hub.n", "hub.own")
    star = members.alias("x").join(best.alias("y"), ["band", "bucket"]).filter(
        (F.col("x.set_key") != F.col("y.set_key")) & possible("x", "y", percent))
    star = star.select(F.col("x.set_key").alias("a"), F.col("y.set_key").alias("b")).distinct()
    links = durable(confirmed(star, sets, percent), "links")
    roots = durable(components(links), "roots")
    # What is left of buckets that lie in more than one component.
    placed = members.join(alive.select("set_key", "bands"), "set_key").join(
        roots.withColumnRenamed("node", "set_key"), "set_key", "left").withColumn("root", F.coalesce("root", "set_key"))
    several = placed.groupBy("band", "bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter(
        "lo <> hi").select("band", "bucket")
    left = durable(placed.join(several, ["band", "bucket"]), "left")
    x, y = left.alias("x"), left.alias("y")
    first_shared = ~F.exists(F.sequence(F.lit(0), F.col("x.band")), lambda k: (k < F.col("x.band")) & (
        F.get(F.col("x.bands"), k) == F.get(F.col("y.bands"), k)))
    rest = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.bucket") == F.col("y.bucket"))
                  & (F.col("x.set_key") < F.col("y.set_key")) & (F.col("x.root") != F.col("y.root"))
                  & possible("x", "y", percent) & first_shared)
    more = durable(confirmed(rest.select(F.col("x.set_key").alias("a"), F.col("y.set_key").alias("b")), sets, percent), "links")
    if not more.isEmpty():
        roots = durable(components(links.union(more)), "roots")
    discard(sets, alive, members, left, links, more)
    # Least id of each component; sets with one copy and no link need no entry.
    full = nodes.select("set_key", "rep", "copies", "head").join(roots.withColumnRenamed("node", "set_key"), "set_key", "left")
    least = full.filter("root is not null").groupBy("root").agg(
        F.min("rep").alias("least"), F.sum("copies").alias("n_class"), F.min("head").alias("_head"))
    label = full.filter("copies > 1 or root is not null").join(least, "root", "left").select(
        F.col("set_key"), F.coalesce("least", "rep").alias("least"), F.coalesce("n_class", "copies").alias("n_class"),
        F.coalesce("_head", "head").alias("head"))
    out = rows.select("doc_id", "text_hash", "n_shingles", "set_key").join(label, "set_key", "left")
    component = F.coalesce("least", "doc_id")
    out = durable(out.select(
        "doc_id", "text_hash", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"), F.coalesce("n_class", F.lit(1)).alias("n_class"),
        (F.col("head").isNull() | (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("text_hash") == F.col("head.text_hash")))
         ).alias("survivor")), "linked")
    discard(rows, nodes, roots)
    return out
